"""Catalog tables derived from the star-schema tables: the same SQL for Spark and for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "sets": ("part", """
select p_brand as set_id, cast(substr(p_brand,7) as int) as set_no, concat('set ', min(p_name)) as name,
  case when cast(substr(p_brand,7) as int)%7=0 then null else cast(1995+cast(substr(p_brand,7) as int)%9 as int) end as release_year,
  cast(case when cast(substr(p_brand,7) as int)%5=0 then 0 else count(*)+cast(substr(p_brand,7) as int)%4-1 end as int) as card_count
from part group by p_brand"""),
    "cards": ("part", """
select p_partkey as id, p_brand as set_id, p_name as name, cast(p_partkey%200 as string) as number, p_type as rarity,
  case when p_partkey%11=0 then null else concat('https://img.example/', cast(p_partkey as string), '.png?x=1') end as image_url,
  case when p_partkey%13=0 then null else cast(p_partkey%500 as bigint) end as product_id, p_retailprice as price
from part"""),
    "price_history": ("lineitem", """
select l_partkey as product_id, cast(l_linenumber as int) as line_no, l_orderkey as ord,
  case concat(l_returnflag,l_linestatus) when 'RO' then 'Reverse Holofoil' when 'RF' then 'Foil' when 'NO' then 'Normal'
    when 'NF' then 'Unlimited' when 'AO' then '1st Edition Holofoil' else 'Non-Holo' end as variant,
  case l_orderkey%4 when 0 then 'Near Mint' when 1 then 'Lightly Played' when 2 then 'Unopened NM' else 'Unplayed' end as cond,
  cast(l_shipdate as date) as bucket_date,
  case when l_discount=0 then cast(0 as double) else l_extendedprice end as market,
  l_extendedprice*(1-l_tax) as low
from lineitem"""),
    "calls": ("events", """
select event_id, user_id as key_id, ts, cast(floor(value) as int)%50 as credits,
  case event_type when 'error' then 'network' when 'purchase' then 'ok' when 'signup' then 'ok' when 'view' then 'other'
    else 'rate_limited' end as outcome, props
from events"""),
}


def view(spark: SparkSession, sf_dir: str, name: str, rows: DataFrame | None = None) -> DataFrame:
    """A derived table over its source table, or over ``rows`` of the same columns, such as a stream."""
    source, sql = VIEWS[name]
    return spark.sql(sql.replace(f"from {source}", "from {source}"), source=spark.read.parquet(f"{sf_dir}/{source}.parquet") if rows is None else rows)


def with_views(sql: str, *names: str) -> str:
    """The oracle's SQL with the views it reads in front."""
    parts = ", ".join(f"{n} AS ({VIEWS[n][1]})" for n in names)
    head, _, rest = sql.strip().partition("WITH ")
    return f"WITH {parts}, {rest}" if not head and rest else f"WITH {parts} {sql}"
