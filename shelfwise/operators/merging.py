"""Joins, merges and updates between a base table and incoming rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: Sequence[str], seq: str | Column) -> DataFrame:
    """The row with the highest ``seq`` of each key.

    Each task sends one row a key; whole rows don't fit into a hash aggregate,
    so Spark sorts within tasks, before and after the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), seq).alias("_last"))
    return last.select(*(F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in df.columns))


def merge_upsert(base: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming columns replace those of the base row with the same key; its other columns stay, new keys get null there."""
    patched = [c for c in incoming.columns if c not in keys]
    new = incoming.select(*keys, F.lit(True).alias("_new"), *(F.col(c).alias(f"_new_{c}") for c in patched))
    both = base.join(new, list(keys), "full_outer")
    have = [*base.columns, *(c for c in patched if c not in base.columns)]
    value = lambda c: F.when(F.col("_new"), F.col(f"_new_{c}")).otherwise(F.col(c) if c in base.columns else F.lit(None)).alias(c)
    return both.select(*(value(c) if c in patched else F.col(c) for c in have))


def insert_ignore(base: DataFrame, incoming: DataFrame, keys: Sequence[str], seq: str | Column) -> DataFrame:
    """Base rows, and of each key that the base lacks the incoming row with the lowest ``seq``."""
    rest = [c for c in incoming.columns if c not in keys]
    first = incoming.groupBy(*keys).agg(F.min_by(F.struct(*rest), seq).alias("_first"))
    rows = first.select(*(F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in incoming.columns))
    return base.unionByName(rows.join(base.select(*keys), list(keys), "left_anti").drop(*(c for c in incoming.columns if c not in base.columns)), allowMissingColumns=True)


def replace_rows(base: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows take the place of the base rows with their keys, whole: columns they lack become null."""
    return base.join(incoming.select(*keys), list(keys), "left_anti").unionByName(incoming, allowMissingColumns=True)


def conditional_update(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c) if c in df.columns else F.lit(None)) for c, v in values.items()})


def sparse_patch(base: DataFrame, patches: DataFrame, key: str, columns: Sequence[str], patch: str = "patch") -> DataFrame:
    """A field absent from the patch (map<string, string>) keeps its value, one that is null in it becomes null."""
    joined = base.join(patches.select(key, patch), key, "left")
    given = lambda c: F.coalesce(F.map_contains_key(patch, c), F.lit(False))
    kinds = dict(base.dtypes)
    return joined.withColumns({c: F.when(given(c), F.try_element_at(patch, F.lit(c)).try_cast(kinds[c])).otherwise(F.col(c)) for c in columns}).drop(patch)


def patch_columns(base: DataFrame, patches: DataFrame, key: str) -> DataFrame:
    """New values of some columns by key; null or no patch leaves the old value.  Patch keys are unique."""
    columns = [c for c in patches.columns if c != key]
    new = patches.select(key, *(F.col(c).alias(f"_new_{c}") for c in columns))
    joined = base.join(new, key, "left")
    have = [*base.columns, *(c for c in columns if c not in base.columns)]
    return joined.select(*(F.coalesce(F.col(f"_new_{c}"), F.col(c) if c in base.columns else F.lit(None)).alias(c) if c in columns else F.col(c) for c in have))


def new_ids(incoming: DataFrame, existing: DataFrame, key: str = "id") -> DataFrame:
    """Incoming rows whose key isn't there yet."""
    return incoming.join(existing.select(key), key, "left_anti")


def sets_to_scrape(sets: DataFrame, cards: DataFrame, force: bool = False, target: str | None = None) -> DataFrame:
    """Sets without a card; with ``force`` all of them, with ``target`` that one alone (an unknown one is an error)."""
    if target is not None:
        found = sets.where(F.col("set_id") == target)
        if found.isEmpty():
            raise ValueError(f"unknown set {target}")
        return found
    return sets if force else sets.join(sets_with_cards(cards), "set_id", "left_anti")


def pending(df: DataFrame, column: str) -> DataFrame:
    """Rows that lack a value."""
    return df.where(F.col(column).isNull())


def pending_product_ids(cards: DataFrame, set_id: str | None = None, limit: int | None = None) -> DataFrame:
    """Cards with a URL but without a product id, by id, of one set or all."""
    rows = cards.where("url IS NOT NULL AND product_id IS NULL")
    rows = (rows if set_id is None else rows.where(F.col("set_id") == set_id)).orderBy("id")
    return rows if limit is None else rows.limit(limit)


def numbered_sets(sets: DataFrame, language: str, numeric_id: int | None = None) -> DataFrame:
    """Sets of a language with a numeric id, or the one with that id; an unknown one is an error."""
    rows = sets.where((F.col("language") == language) & F.col("numeric_id").isNotNull())
    if numeric_id is None:
        return rows
    found = rows.where(F.col("numeric_id") == numeric_id)
    if found.isEmpty():
        raise ValueError(f"unknown {language} set {numeric_id}")
    return found


def sets_with_cards(cards: DataFrame) -> DataFrame:
    return cards.where("set_id IS NOT NULL AND set_id <> ''").select("set_id").distinct()


def fan_out_prices(cards: DataFrame, prices: DataFrame, at: Column) -> DataFrame:
    """Each product's best price, price map and time of the refresh on all cards with that product.

    ``prices`` has product_id, prices and best_price.  Cards of other products
    keep price, prices and scraped_at (null if they have no such columns);
    null products never enter the join.
    """
    new = prices.select("product_id", F.col("best_price").alias("_price"), F.col("prices").alias("_prices"))
    have = cards.withColumns({c: F.lit(None).cast(t) for c, t in (("prices", prices.schema["prices"].dataType), ("scraped_at", "timestamp")) if c not in cards.columns})
    joined = have.where("product_id IS NOT NULL").join(new, "product_id", "left")
    hit = F.col("_price").isNotNull()
    changed = {
        "price": F.coalesce("_price", "price"),
        "prices": F.when(hit, F.col("_prices")).otherwise(F.col("prices")),
        "scraped_at": F.when(hit, at).otherwise(F.col("scraped_at")),
    }
    return joined.withColumns(changed).select(*have.columns).unionByName(have.where("product_id IS NULL"))


def english_names(cards: DataFrame, names: DataFrame, numbers: str = "dex_ids") -> DataFrame:
    """english_name by the first of a card's numbers; null unless it is in the list."""
    listed = names.select(F.col("position").alias("_position"), F.col("name").alias("english_name"))
    return cards.join(listed, F.try_element_at(F.col(numbers), F.lit(1)) == F.col("_position"), "left").drop("_position")


def _grams(name: str, sizes: Sequence[int]) -> Column:
    """A name's distinct parts of the given lengths."""
    part = lambda n: F.when(F.length(name) >= n, F.transform(F.sequence(F.lit(1), F.length(name) - n + 1), lambda i: F.substring(F.col(name), i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(*map(part, sizes)))


#: Names that hold a short needle may be very many: they are dealt over so many tasks.
DEALS = 16


def _holding(needles: DataFrame, hays: DataFrame, k: int) -> DataFrame:
    """(needle, first, hay) of distinct needles that aren't empty and the distinct hays that hold them, with what stands beside either.

    A needle of k characters or more meets the hays that have its rarest
    k-gram, a shorter one those of which it is a gram itself.  The grams of the
    hays are built once; those that no needle has are never counted.
    """
    short = F.length("gram") < k
    whole = F.when(F.length("needle") < k, F.array("needle")).otherwise(_grams("needle", [k]))
    pieces = needles.where("needle <> ''").select("needle", F.explode(whole).alias("gram"))
    grams = hays.withColumn("gram", F.explode(_grams("hay", list(range(1, k + 1)))))
    counts = grams.join(pieces.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    probes = pieces.join(counts, "gram").groupBy("needle").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))
    dealt = grams.withColumn("deal", F.when(short, F.pmod(F.xxhash64("hay"), F.lit(DEALS))).otherwise(0))
    copied = probes.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.when(short, F.lit(DEALS - 1)).otherwise(0).cast("long"))))
    return copied.join(dealt, ["gram", "deal"]).where(F.contains("hay", "needle")).drop("gram", "deal")


def match_names(left: DataFrame, right: DataFrame, k: int = 5) -> DataFrame:
    """(left_id, right_id): loose matches of lower-case names, at most one for each left row, the first in the right's order.

    a matches b if either holds the other, or b holds a without its colons.
    Left has (left_id, name), right has (right_id, position, name).  Names
    shorter than k, which very many others may hold, are never paired with all
    of them: of a short a only the first b that has it counts, which is a
    minimum over the grams of all b, and a short b is looked up once for each
    of an a's grams.
    """
    a = left.select("left_id", F.lower("name").alias("a")).withColumn("bare", F.replace("a", F.lit(":"), F.lit("")))
    b = right.select("right_id", "position", F.lower("name").alias("b"))
    order = F.struct("position", "right_id")
    firsts = b.groupBy("b").agg(F.min(order).alias("first"))  # of candidates with one name only the first can win
    forms = a.select("left_id", F.explode(F.array_distinct(F.array("a", "bare"))).alias("needle"))
    # a, or a without colons, within b: of the b that hold it only the first counts
    ahead = _holding(forms.select("needle").distinct(), firsts.select(F.col("b").alias("hay"), "first"), k).groupBy("needle").agg(F.min("first").alias("first"))
    by_form = forms.join(ahead, "needle").select("left_id", "first")
    # b within a
    back = _holding(firsts.select(F.col("b").alias("needle")), a.select(F.col("a").alias("hay")).distinct(), k)
    within = back.join(firsts, F.col("needle") == F.col("b")).groupBy("hay").agg(F.min("first").alias("first"))
    by_name = a.join(within, F.col("a") == F.col("hay")).select("left_id", "first")
    # an empty name, or one of colons alone, lies in every name: it takes the first candidate
    every = b.agg(F.min(order).alias("first")).where("first IS NOT NULL")
    empty = a.where("bare = ''").select("left_id").crossJoin(F.broadcast(every))  # one row
    best = by_form.unionByName(by_name).unionByName(empty).groupBy("left_id").agg(F.min("first").alias("m"))
    return best.select("left_id", F.col("m.right_id").alias("right_id"))


def backlog(sets: DataFrame, cards: DataFrame, completed: Sequence[int] | None = None) -> DataFrame:
    """Each set's existing cards, whether it is done (by count or by the completed list), and how many remain."""
    counts = cards.groupBy("set_id").agg(F.count(F.lit(1)).alias("existing"))
    listed = F.array(*(F.lit(int(c)) for c in completed)) if completed else F.array().cast("array<int>")
    joined = sets.join(counts, "set_id", "left").withColumn("existing", F.coalesce("existing", F.lit(0)).cast("long"))
    from ..functions.scalars import set_done

    done = set_done(F.col("card_count"), F.col("existing"), F.col("set_no"), listed)
    remaining = F.greatest(F.col("card_count") - F.col("existing"), F.lit(0)).cast("long")
    return joined.withColumn("done", done).withColumn("remaining", remaining)


def classify_incoming(incoming: DataFrame, existing: DataFrame, force: bool = False) -> DataFrame:
    """status: skipped if the id exists (unless forced), else failed without an image, else accepted."""
    there = existing.select(F.col("id").alias("_id")).distinct()
    joined = incoming.join(there, F.col("id") == F.col("_id"), "left")
    exists = F.col("_id").isNotNull() & F.lit(not force)
    return joined.withColumn("status", F.when(exists, "skipped").when(F.coalesce("image_url", F.lit("")) == "", "failed").otherwise("accepted")).drop("_id")


def check_constraints(df: DataFrame, required: Sequence[str] = (), enums: dict[str, Sequence[str]] | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``reasons``, an array of broken rules: not-null:<c>, enum:<c>, duplicate; empty for valid rows."""
    rules = [F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", f"not-null:{c}") for c in required]
    rules += [F.when(F.col(c).isNotNull() & ~F.col(c).isin(*allowed), f"enum:{c}") for c, allowed in (enums or {}).items()]
    if keys:
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies")).where("_copies > 1")
        df = df.join(counts, list(keys), "left")
        rules.append(F.when(F.col("_copies").isNotNull(), "duplicate"))
    return df.withColumn("reasons", F.array_compact(F.array(*rules))).drop("_copies")


def usable_keys(keys: DataFrame, states: DataFrame, today: Column) -> DataFrame:
    """Keys that may be used: unknown ones, those last seen on another day (remaining unknown), and active ones."""
    joined = keys.join(states, "key_id", "left")
    other_day = F.col("state_day") != today
    usable = F.col("status").isNull() | ((F.col("status") != "disabled") & (other_day | (F.col("status") == "active")))
    return joined.where(usable).select(*keys.columns, F.when(other_day, None).otherwise(F.col("remaining")).alias("remaining"))


def rollover_keys(keys: DataFrame, states: DataFrame, today: Column) -> DataFrame:
    """States of all keys at the start of a day: rate-limited ones of another day, and unknown ones, are active with nothing used.

    States have key_id, status, state_day, credits_used, remaining,
    rate_limited_at and last_error; ``keys`` has key_id.
    """
    known = states.withColumn("_known", F.lit(True))
    joined = keys.select("key_id").join(known, "key_id", "left")
    reset = F.coalesce((F.col("status") == "rate_limited") & (F.col("state_day") != today), F.lit(False))
    fresh = reset | F.col("_known").isNull()
    cleared = {c: F.when(~reset, F.col(c)) for c in ("remaining", "rate_limited_at", "last_error")}
    changed = {"status": F.when(fresh, "active").otherwise(F.col("status")), "credits_used": F.when(fresh, 0).otherwise(F.col("credits_used")), "state_day": today}
    return joined.withColumns(cleared | changed).select(*states.columns)
