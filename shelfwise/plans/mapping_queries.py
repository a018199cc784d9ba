"""Queries over JSON items made from ``part``, with every field that the items' source gives.

An item's JSON is written in SQL that both engines read; the expected columns
are written by hand beside it.  A field whose SQL is null is missing.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import mapping, merging
from ..sources import landing
from .registry import read, registered

KEY, BRAND = "cast(p_partkey as string)", "substr(p_brand, 7)"


def text(sql: str) -> str:
    return f"concat('\"', {sql}, '\"')"


def json(fields: dict[str, str]) -> str:
    """SQL for the JSON object of these fields."""
    return "concat('{', concat_ws(',', " + ", ".join(f"'\"{name}\":' || ({sql})" for name, sql in fields.items()) + "), '}')"


def select(columns: dict[str, str], rows: str = "part") -> str:
    return "SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in columns.items()) + f" FROM {rows}"


def joined(df, *lists: str):
    """Lists as text, so that both engines show them alike."""
    return df.withColumns({c: F.array_join(c, "|") for c in lists})


NONE, NO_INT = "CAST(NULL AS VARCHAR)", "CAST(NULL AS INTEGER)"
SETS = "(SELECT DISTINCT p_brand FROM part)"

# ---------------------------------------------------------------- sets

CATALOG_SET = {
    "id": text("p_brand"),
    "name": f"case when {BRAND} < '20' then {text('p_brand')} when {BRAND} < '30' then 'null' end",
    "series": f"case when {BRAND} >= '20' then '\"Base\"' end",
    "printedTotal": BRAND,
    "total": f"case when {BRAND} = '11' then '\"many\"' else {BRAND} end",
    "ptcgoCode": text(f"concat('P', {BRAND})"),
    "releaseDate": "'\"1999/01/09\"'",
    "images": f"case when {BRAND} <> '12' then {json({'symbol': text('p_brand'), 'logo': "case when p_brand > 'Brand#3' then '" + '"l"' + "' end"})} end",
}
CATALOG_SET_COLUMNS = {
    "id": "p_brand",
    "name": f"CASE WHEN {BRAND} < '20' THEN p_brand ELSE '' END",
    "series": f"CASE WHEN {BRAND} >= '20' THEN 'Base' END",
    "printed_total": f"CAST({BRAND} AS INTEGER)",
    "total": f"CASE WHEN {BRAND} <> '11' THEN CAST({BRAND} AS INTEGER) END",
    "ptcgo_code": f"concat('P', {BRAND})",
    "release_date": "'1999/01/09'",
    "symbol_url": f"CASE WHEN {BRAND} <> '12' THEN p_brand END",
    "logo_url": f"CASE WHEN {BRAND} <> '12' AND p_brand > 'Brand#3' THEN 'l' END",
}


def _sets(spark, d, fields):
    return read(spark, d, "part").select("p_brand").distinct().select(F.expr(json(fields)).alias("item"))


def _cards(spark, d, fields):
    return read(spark, d, "part").select(F.expr(json(fields)).alias("item"))


@registered(select(CATALOG_SET_COLUMNS, SETS))
def p1_map_sets_catalog(spark, d):
    return mapping.map_sets_catalog(_sets(spark, d, CATALOG_SET))


JA_SET = {
    "id": text("p_brand"),
    "name": text("p_brand"),
    "serie": f"case when {BRAND} < '20' then {json({'name': text('p_brand')})} else '\"none\"' end",
    "cardCount": json({"official": BRAND, "total": f"case when {BRAND} > '30' then {BRAND} end"}),
    "releaseDate": "'\"2020-02-03\"'",
    "logo": f"case when {BRAND} < '30' then '\"l\"' when {BRAND} < '40' then '\"\"' end",
    "symbol": f"case when {BRAND} > '30' then '\"s\"' end",
}
JA_SET_COLUMNS = {
    "id": "p_brand",
    "name": "p_brand",
    "series": f"CASE WHEN {BRAND} < '20' THEN p_brand END",
    "printed_total": f"CAST({BRAND} AS INTEGER)",
    "total": f"CASE WHEN {BRAND} > '30' THEN CAST({BRAND} AS INTEGER) END",
    "release_date": "'2020-02-03'",
    "logo_url": f"CASE WHEN {BRAND} < '30' THEN 'l.webp' END",
    "symbol_url": f"CASE WHEN {BRAND} > '30' THEN 's.webp' END",
    "language": "'ja'",
}


@registered(select(JA_SET_COLUMNS, SETS))
def p3_map_sets_ja(spark, d):
    return mapping.map_sets_ja(_sets(spark, d, JA_SET))


TRACKER_SET = {
    "id": text("p_brand"),
    "tcgPlayerId": text(f"concat('t', {BRAND})"),
    "tcgPlayerNumericId": f"case when {BRAND} <> '11' then {BRAND} end",
    "name": f"case when {BRAND} > '20' then {text('p_brand')} else 'null' end",
    "series": "'\"S\"'",
    "releaseDate": f"case when {BRAND} > '30' then '\"2021-05-06\"' else '\"soon\"' end",
    "cardCount": BRAND,
    "imageCdnUrl": "'\"c\"'",
    "imageCdnUrl200": "'\"c2\"'",
    "imageCdnUrl400": "'\"c4\"'",
    "imageCdnUrl800": "'\"c8\"'",
    "imageUrl": "'\"i\"'",
    "priceGuideUrl": "'\"g\"'",
    "hasPriceGuide": f"case when {BRAND} = '11' then 'true' else 'false' end",
    "noPriceGuideReason": "'\"r\"'",
    "createdAt": "'\"2024-01-02T03:04:05Z\"'",
    "updatedAt": "'null'",
}
TRACKER_SET_COLUMNS = {
    "language": "'english'",
    "ppt_id": "p_brand",
    "tcg_player_id": f"concat('t', {BRAND})",
    "tcg_player_numeric_id": f"CASE WHEN {BRAND} <> '11' THEN CAST({BRAND} AS INTEGER) END",
    "name": f"CASE WHEN {BRAND} > '20' THEN p_brand ELSE '' END",
    "series": "'S'",
    "release_date": f"CASE WHEN {BRAND} > '30' THEN date '2021-05-06' END",
    "card_count": f"CAST({BRAND} AS INTEGER)",
    "image_cdn_url": "'c'",
    "image_cdn_url_200": "'c2'",
    "image_cdn_url_400": "'c4'",
    "image_cdn_url_800": "'c8'",
    "image_url": "'i'",
    "price_guide_url": "'g'",
    "has_price_guide": f"{BRAND} = '11'",
    "no_price_guide_reason": "'r'",
    "api_created_at": "'2024-01-02 03:04:05'",
    "api_updated_at": NONE,
    "raw": json(TRACKER_SET),
}


@registered(select(TRACKER_SET_COLUMNS, SETS))
def p5_map_sets_tracker(spark, d):
    rows = mapping.map_sets_tracker(_sets(spark, d, TRACKER_SET), "english").drop("synced_at")
    return rows.withColumns({c: F.col(c).cast("string") for c in ("api_created_at", "api_updated_at")})


# ---------------------------------------------------------------- cards

PRICES = json({
    "holofoil": json({"market": "case p_partkey%4 when 0 then 'null' when 1 then '\"5\"' when 2 then '-1' else '0' end", "mid": "case when p_partkey%3=0 then 'null' else '2.5' end"}),
    "normal": json({"market": "cast(p_size as string)"}),
})
CATALOG_CARD = {
    "id": text(KEY),
    "name": "case when p_partkey%9=0 then 'null' else " + text("p_name") + " end",
    "set": json({"id": text("p_brand"), "name": text("p_type"), "ptcgoCode": text("concat('P', p_brand)"), "printedTotal": "case when p_partkey%4=0 then 'null' else '180' end"}),
    "number": text("cast(p_partkey%200 as string)"),
    "supertype": "'\"Trainer\"'",
    "subtypes": "case when p_partkey%5=1 then '[\"Basic\",\"EX\"]' end",
    "hp": text("case when p_partkey%6=0 then 'x' else cast(p_size*10 as string) end"),
    "types": "case when p_partkey%5=0 then 'null' else '[\"Fire\",\"Water\"]' end",
    "rarity": text("p_type"),
    "images": json({"small": text(f"concat('s', {KEY})"), "large": "case when p_partkey%2=0 then '\"l\"' end"}),
    "artist": text("p_type"),
    "flavorText": "case when p_partkey%3=0 then '\"It, sleeps.\"' end",
    "regulationMark": "'\"F\"'",
    "evolvesFrom": "case when p_partkey%7=0 then " + text("p_name") + " end",
    "evolvesTo": "case when p_partkey%7=1 then '[\"a\"]' end",
    "rules": "case when p_partkey%8=0 then '[\"r1\",\"r2\"]' else '\"none\"' end",
    "abilities": "'[{\"name\":\"A\",\"n\":1}]'",
    "attacks": "concat('[{\"name\":\"Hit\",\"damage\":', cast(p_size as string), '}]')",
    "weaknesses": "'null'",
    "retreatCost": "'[\"Colorless\"]'",
    "convertedRetreatCost": "case when p_partkey%2=0 then '1' else '\"x\"' end",
    "legalities": "'{\"unlimited\":\"Legal\"}'",
    "tcgplayer": f"case when p_partkey%10<>0 then {json({'url': text(f'concat({chr(39)}u{chr(39)}, {KEY})'), 'prices': PRICES})} end",
}
BEST = "CASE WHEN p_partkey%10=0 THEN 0.0 WHEN p_partkey%4 IN (0,3) AND p_partkey%3<>0 THEN 2.5 ELSE CAST(p_size AS DOUBLE) END"
CATALOG_CARD_COLUMNS = {
    "id": KEY,
    "name": "CASE WHEN p_partkey%9=0 THEN '' ELSE p_name END",
    "set_id": "p_brand",
    "card_number": "cast(p_partkey%200 as string)",
    "supertype": "'Trainer'",
    "subtypes": "CASE WHEN p_partkey%5=1 THEN 'Basic|EX' ELSE '' END",
    "hp": "CASE WHEN p_partkey%6=0 THEN 'x' ELSE cast(p_size*10 as string) END",
    "types": "CASE WHEN p_partkey%5=0 THEN '' ELSE 'Fire|Water' END",
    "rarity": "p_type",
    "image_large": "CASE WHEN p_partkey%2=0 THEN 'l' END",
    "image_small": f"concat('s', {KEY})",
    "artist": "p_type",
    "flavor_text": "CASE WHEN p_partkey%3=0 THEN 'It, sleeps.' END",
    "regulation_mark": "'F'",
    "evolves_from": "CASE WHEN p_partkey%7=0 THEN p_name END",
    "evolves_to": "CASE WHEN p_partkey%7=1 THEN 'a' ELSE '' END",
    "rules": "CASE WHEN p_partkey%8=0 THEN 'r1|r2' ELSE '' END",
    "abilities": "'{\"name\":\"A\",\"n\":1}'",
    "attacks": "concat('{\"name\":\"Hit\",\"damage\":', cast(p_size as string), '}')",
    "weaknesses": "''",
    "resistances": "''",
    "retreat_cost": "'Colorless'",
    "converted_retreat_cost": "CASE WHEN p_partkey%2=0 THEN 1 END",
    "legalities": "'{\"unlimited\":\"Legal\"}'",
    "tcgplayer_url": f"CASE WHEN p_partkey%10<>0 THEN concat('u', {KEY}) END",
    "tcgplayer_prices": f"CASE WHEN p_partkey%10<>0 THEN {PRICES} ELSE '{{}}' END",
    "market_price": BEST,
}
LISTS = ("subtypes", "types", "evolves_to", "rules", "abilities", "attacks", "weaknesses", "resistances", "retreat_cost")


@registered(select(CATALOG_CARD_COLUMNS))
def p2_map_cards_catalog(spark, d):
    return joined(mapping.map_cards_catalog(_cards(spark, d, CATALOG_CARD)), *LISTS)


JA_CARD = {
    "id": text(f"concat('j', {KEY})"),
    "name": text("p_name"),
    "set": json({"id": text("p_brand")}),
    "localId": text("cast(p_partkey%200 as string)"),
    "category": "'\"Pocket\"'",
    "stage": text("case when p_partkey%2=0 then 'Basic' else '' end"),
    "hp": "cast(p_size%5*10 as string)",
    "types": "case when p_partkey%4=0 then '[\"Fire\"]' end",
    "rarity": text("p_type"),
    "image": f"case when p_partkey%3<>0 then {text(f'concat({chr(39)}u{chr(39)}, {KEY})')} end",
    "illustrator": text("p_type"),
    "description": "'\"d\"'",
    "regulationMark": "'\"G\"'",
    "evolveFrom": text("p_name"),
    "dexId": "case when p_partkey%11=0 then '\"x\"' else concat('[', cast(p_partkey%300 as string), ',1]') end",
}
JA_CARD_COLUMNS = {
    "id": f"concat('j', {KEY})",
    "name": "p_name",
    "set_id": "p_brand",
    "card_number": "cast(p_partkey%200 as string)",
    "supertype": "'Pocket'",
    "subtypes": "CASE WHEN p_partkey%2=0 THEN 'Basic' ELSE '' END",
    "hp": "CASE WHEN p_size%5<>0 THEN cast(p_size%5*10 as string) END",
    "types": "CASE WHEN p_partkey%4=0 THEN 'Fire' ELSE '' END",
    "rarity": "p_type",
    "image_large": f"CASE WHEN p_partkey%3<>0 THEN concat('u', {KEY}, '/high.webp') END",
    "image_small": f"CASE WHEN p_partkey%3<>0 THEN concat('u', {KEY}, '/low.webp') END",
    "artist": "p_type",
    "flavor_text": "'d'",
    "regulation_mark": "'G'",
    "evolves_from": "p_name",
    "dex_ids": "CASE WHEN p_partkey%11<>0 THEN concat(cast(p_partkey%300 as string), '|1') END",
    "market_price": "0.0::DOUBLE",
    "language": "'ja'",
    "english_name": "n_name",
}


@registered("WITH names AS (SELECT row_number() OVER (ORDER BY n_nationkey) AS position, n_name FROM nation) " + select(JA_CARD_COLUMNS, "part LEFT JOIN names ON position = CASE WHEN p_partkey%11<>0 THEN p_partkey%300 END"))
def p4_map_cards_ja(spark, d):
    cards = mapping.map_cards_ja(_cards(spark, d, JA_CARD))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda s: s["n_name"])
    names = landing.name_list(read(spark, d, "nation").agg(F.to_json(in_order).alias("value")))
    return joined(merging.english_names(cards, names), "subtypes", "types").withColumn("dex_ids", F.array_join(F.col("dex_ids").cast("array<string>"), "|"))


TRACKER_CARD = {
    "id": text(f"concat('p', {KEY})"),
    "tcgPlayerId": f"case when p_partkey%10=0 then null when p_partkey%10=1 then {KEY} else {text(KEY)} end",
    "setId": BRAND,
    "setName": text("p_brand"),
    "name": "case when p_partkey%9=0 then 'null' else " + text("p_name") + " end",
    "cardNumber": text("cast(p_partkey%200 as string)"),
    "rarity": text("p_type"),
    "cardType": "'\"c\"'",
    "pokemonType": "'\"Fire\"'",
    "energyType": "case when p_partkey%2=0 then '[\"Fire\",\"Water\"]' else '\"Fire\"' end",
    "flavorText": "'\"f\"'",
    "hp": text("case when p_partkey%6=0 then 'x' else cast(p_size*10 as string) end"),
    "stage": "'\"Basic\"'",
    "attacks": "'[\"Hit\"]'",
    "weakness": "'{\"type\":\"Water\"}'",
    "resistance": "'null'",
    "retreatCost": "cast(p_size%4 as string)",
    "artist": text("p_type"),
    "tcgPlayerUrl": "'\"u\"'",
    "prices": f"case when p_partkey%7<>0 then {json({'market': '''cast(p_size as string) || '.25' ''', 'low': "'1.5'", 'listings': 'cast(p_size as string)', 'sellers': "'3'", 'primaryPrinting': "'" + '"Normal"' + "'", 'lastUpdated': "'" + '"2024-05-06T07:08:09Z"' + "'", 'priceWasCorrected': "'true'"})} end",
    "variants": "'{\"Normal\":{\"marketPrice\":1}}'",
    "printingsAvailable": "case when p_partkey%3=0 then '\"A\"' else '[\"A\",\"B\"]' end",
    "imageCdnUrl": "'\"c\"'",
    "imageCdnUrl200": "'\"c2\"'",
    "imageCdnUrl400": "'\"c4\"'",
    "imageCdnUrl800": "'\"c8\"'",
    "imageUrl": "'\"i\"'",
    "externalCatalogId": text(f"concat('x', {KEY})"),
    "needsDetailedScrape": "'false'",
    "dataCompleteness": "'\"full\"'",
    "lastScrapedAt": "'\"2024-01-02T03:04:05Z\"'",
    "createdAt": "'null'",
    "updatedAt": "'\"2024-01-02T03:04:06Z\"'",
}
PRICED = "p_partkey%7<>0"
TRACKER_CARD_COLUMNS = {
    "language": "'english'",
    "ppt_id": f"concat('p', {KEY})",
    "tcg_player_id": f"CASE WHEN p_partkey%10=0 THEN '' ELSE {KEY} END",
    "set_numeric_id": f"CAST({BRAND} AS INTEGER)",
    "set_name": "p_brand",
    "name": "CASE WHEN p_partkey%9=0 THEN '' ELSE p_name END",
    "card_number": "cast(p_partkey%200 as string)",
    "rarity": "p_type",
    "card_type": "'c'",
    "pokemon_type": "'Fire'",
    "energy_type": "CASE WHEN p_partkey%2=0 THEN 'Fire|Water' END",
    "flavor_text": "'f'",
    "hp": "CAST(CASE WHEN p_partkey%6<>0 THEN p_size*10 END AS INTEGER)",
    "stage": "'Basic'",
    "attacks": "'Hit'",
    "weakness": "'{\"type\":\"Water\"}'",
    "resistance": NONE,
    "retreat_cost": "CAST(p_size%4 AS INTEGER)",
    "artist": "p_type",
    "tcg_player_url": "'u'",
    "price_market": f"CASE WHEN {PRICED} THEN p_size + 0.25::DOUBLE END",
    "price_low": f"CASE WHEN {PRICED} THEN 1.5::DOUBLE END",
    "listings": f"CASE WHEN {PRICED} THEN CAST(p_size AS INTEGER) END",
    "sellers": f"CASE WHEN {PRICED} THEN 3 END",
    "primary_printing": f"CASE WHEN {PRICED} THEN 'Normal' END",
    "price_last_updated": f"CASE WHEN {PRICED} THEN '2024-05-06 07:08:09' END",
    "price_was_corrected": f"CASE WHEN {PRICED} THEN true END",
    "variants": "'{\"Normal\":{\"marketPrice\":1}}'",
    "printings_available": "CASE WHEN p_partkey%3<>0 THEN 'A|B' END",
    "image_cdn_url": "'c'",
    "image_cdn_url_200": "'c2'",
    "image_cdn_url_400": "'c4'",
    "image_cdn_url_800": "'c8'",
    "image_url": "'i'",
    "external_catalog_id": f"concat('x', {KEY})",
    "needs_detailed_scrape": "false",
    "data_completeness": "'full'",
    "last_scraped_at": "'2024-01-02 03:04:05'",
    "api_created_at": NONE,
    "api_updated_at": "'2024-01-02 03:04:06'",
    "raw": json(TRACKER_CARD),
}


@registered(select(TRACKER_CARD_COLUMNS))
def p6_map_cards_tracker(spark, d):
    rows = mapping.map_cards_tracker(_cards(spark, d, TRACKER_CARD), "english").drop("synced_at")
    shown = {c: F.col(c).cast("string") for c in ("price_last_updated", "last_scraped_at", "api_created_at", "api_updated_at")}
    return joined(rows.withColumns(shown | {c: F.col(c).cast("double") for c in ("price_market", "price_low")}), "energy_type", "attacks", "printings_available")


OFFLINE_COLUMNS = {
    "id": KEY,
    "name": "CASE WHEN p_partkey%9=0 THEN 'Unknown' ELSE p_name END",
    "set_name": "p_type",
    "card_number": "CASE WHEN p_partkey%4=0 THEN cast(p_partkey%200 as string) ELSE concat(cast(p_partkey%200 as string), '/180') END",
    "hp": CATALOG_CARD_COLUMNS["hp"],
    "set_id": "p_brand",
    "set_code": "concat('P', p_brand)",
    "image_url": f"CASE WHEN p_partkey%2=0 THEN 'l' ELSE concat('s', {KEY}) END",
    "rarity": "p_type",
    "types": "CASE WHEN p_partkey%5<>0 THEN 'Fire, Water' END",
    "stamped": "true",
}


@registered(select(OFFLINE_COLUMNS))
def p7_map_cards_offline(spark, d):
    return mapping.map_cards_offline(_cards(spark, d, CATALOG_CARD)).withColumn("updated_at", F.col("updated_at").isNotNull()).withColumnRenamed("updated_at", "stamped")


FOIL = "case when p_partkey%2=0 then '\"n/a\"' else '{\"marketPrice\":null,\"conditionUsed\":\"NM\"}' end"
NORMAL = "concat('{\"marketPrice\":', cast(p_size as string), ',\"lowPrice\":1.5}')"
VARIANTS = {
    "tcgPlayerId": f"case when p_partkey%7=0 then '\"\"' when p_partkey%7=1 then {KEY} else {text(KEY)} end",
    "variants": f"case when p_partkey%5=0 then '[1]' else {json({'Normal': NORMAL, 'Foil': FOIL})} end",
}


@registered(f"""SELECT 'english' AS language, {KEY} AS card_tcg_player_id, 'Normal' AS printing, CAST(p_size AS DOUBLE) AS market_price, 1.5::DOUBLE AS low_price,
  CAST(NULL AS VARCHAR) AS condition_used, {NORMAL} AS raw
FROM part WHERE p_partkey%7<>0 AND p_partkey%5<>0
UNION ALL SELECT 'english', {KEY}, 'Foil', NULL, NULL, 'NM', {FOIL} FROM part WHERE p_partkey%7<>0 AND p_partkey%5<>0 AND p_partkey%2<>0""")
def p9_price_variants(spark, d):
    return mapping.explode_price_variants(_cards(spark, d, VARIANTS), "english").drop("synced_at")
