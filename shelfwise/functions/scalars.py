"""Column functions of the catalog jobs, all built from Spark's own expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Price variants in the order in which they are tried, as catalogs and as price histories spell them.
CATALOG_VARIANTS = ("holofoil", "normal", "reverseHolofoil", "1stEditionHolofoil")
HISTORY_VARIANTS = ("holofoil", "normal", "reverseholofoil", "1steditionholofoil", "1steditionnormal")
#: Parts of a condition's name that mean near mint, and messages that mean an invalid key.
NEAR_MINT = ("near mint", "nm", "unplayed")
INVALID_KEY = "invalid api key|unauthorized|forbidden|authentication|api key"


def near_mint(condition: Column) -> Column:
    """Whether a condition names near mint, anywhere in it and in any case."""
    low = F.lower(condition)
    found = F.lit(False)
    for part in NEAR_MINT:
        found = found | F.contains(low, F.lit(part))
    return F.coalesce(found, F.lit(False))


def _once(value: Column, change: Callable[[Column], Column]) -> Column:
    """``change`` of a value that is computed once, however often ``change`` reads it."""
    return F.element_at(F.transform(F.array(value), change), 1)


def normalize_variant(name: Column) -> Column:
    """The canonical key of a printing's name; null where no letter or digit is left."""

    def canonical(key: Column) -> Column:
        has = lambda part: F.contains(key, F.lit(part))
        return (
            F.when(key == "", F.lit(None))
            .when(key == "foil", "foil")
            .when(has("reverse") & has("holo"), "reverseholofoil")
            .when(has("1stedition") & has("holo"), "1steditionholofoil")
            .when(has("1stedition"), "1steditionnormal")
            .when(has("holo"), "holofoil")
            .when(has("normal") | has("unlimited"), "normal")
            .otherwise(key)
        )

    return _once(F.regexp_replace(F.lower(name), "[^a-z0-9]", ""), canonical)


def best_catalog_price(prices_json: Column, variants: Sequence[str] = CATALOG_VARIANTS) -> Column:
    """The first variant's market price, or its mid price where market is missing, null, 0 or ''; 0.0 if there is none.

    Only a positive JSON number counts.  A market price that is text or
    negative is present, so the variant is skipped and mid isn't looked at.
    """
    number = ", ".join(f"`{v}`: STRUCT<market: DOUBLE, mid: DOUBLE>" for v in variants)
    text = ", ".join(f"`{v}`: STRUCT<market: STRING, mid: STRING>" for v in variants)
    as_number, as_text = F.from_json(prices_json, f"STRUCT<{number}>"), F.from_json(prices_json, f"STRUCT<{text}>")
    found = []
    for v in variants:
        market, shown = as_number[v]["market"], as_text[v]["market"]
        present = shown.isNotNull() & (shown != "") & (F.coalesce(market, F.lit(1.0)) != 0.0) & (shown != "false")
        value = F.when(present, market).otherwise(as_number[v]["mid"])
        found.append(F.when(value > 0, value))
    return F.coalesce(*found, F.lit(0.0))


def best_history_price(prices: Column, variants: Sequence[str] = HISTORY_VARIANTS) -> Column:
    """From map<variant, struct<market, low>>: the first known variant's market price, else that of the first entry, else 0.0."""
    known = [F.try_element_at(prices, F.lit(v))["market"] for v in variants]
    return F.coalesce(*known, F.try_element_at(F.map_values(prices), F.lit(1))["market"], F.lit(0.0))


def extract_product_id(url: Column) -> Column:
    """The number after /product/ in a percent-encoded URL, else that of the productId parameter; 0 is none."""
    plain = F.coalesce(F.try_url_decode(F.replace(url, F.lit("+"), F.lit("%2B"))), url)
    path, query = (F.regexp_extract(plain, p, 1) for p in (r"/product/(\d+)", r"[?&]productId=(\d+)"))
    number = F.coalesce(F.nullif(path, F.lit("")), F.nullif(query, F.lit(""))).try_cast("long")
    return F.nullif(number, F.lit(0).cast("long"))


def display_number(number: Column, total: Column) -> Column:
    """number/total, unless the total is unknown or the number has a slash already."""
    return F.when(total.isNull() | F.contains(number, F.lit("/")), number).otherwise(F.concat(number, F.lit("/"), total.cast("string")))


def join_types(types: Column) -> Column:
    """A list as text; null elements are left out, a null list stays null."""
    return F.array_join(types, ", ")


def asset_extension(url: Column) -> Column:
    """What follows the last dot, without a query; png where that is empty or longer than 4."""
    end = F.element_at(F.split(url, r"\."), -1)
    short = F.element_at(F.split(end, r"\?"), 1)
    return F.when((short == "") | (F.length(short) > 4), "png").otherwise(short)


def asset_path(url: Column, item_id: Column) -> Column:
    return F.concat(item_id, F.lit("."), asset_extension(url))


def public_url(store: str, bucket: str, path: Column) -> Column:
    """Where a stored asset can be fetched by anyone."""
    return F.concat(F.lit(f"{store}/storage/v1/object/public/{bucket}/"), path)


def to_int_strict(text: Column) -> Column:
    """Null unless the whole text, trimmed, is a whole number."""
    return F.when(F.trim(text).rlike(r"^[+-]?\d+$"), F.trim(text).try_cast("int"))


def to_int_lenient(text: Column) -> Column:
    """The number that a text starts with, or null."""
    return F.nullif(F.regexp_extract(text, r"^\s*([+-]?\d+)", 1), F.lit("")).try_cast("int")


def text_array(json: Column) -> Column:
    """A JSON array's elements as text; null for any other value."""
    return F.when(F.startswith(F.ltrim(json), F.lit("[")), F.from_json(json, "array<string>"))


def set_done(card_count: Column, existing: Column, set_no: Column, completed: Column) -> Column:
    """All cards of a known count are there, or the set is on the completed list."""
    return ((card_count > 0) & (existing >= card_count)) | F.coalesce(F.array_contains(completed, set_no), F.lit(False))


def start_offset(policy: str, existing: Column, checkpoint_offset: Column, checkpoint_is_today: Column, force: bool = False) -> Column:
    """Where a set's next page starts.  ``checkpoint_offset`` is null unless the checkpoint is on this set."""
    if force:
        return F.lit(0).cast("long")
    if policy == "checkpoint":
        return F.coalesce(checkpoint_offset, F.lit(0)).cast("long")
    if policy == "existing":
        return F.greatest(existing, F.when(checkpoint_is_today, checkpoint_offset)).cast("long")
    raise ValueError(f"unknown policy {policy}")


def classify_failure(status: Column, message: Column) -> Column:
    """An invalid key first, whatever the status; then the rate limit; then any other failure."""
    return F.when(F.coalesce(message, F.lit("")).rlike(f"(?i){INVALID_KEY}"), "disabled").when(status == 429, "rate_limited").otherwise("failed")


def key_status_after_call(remaining: Column, reserve: int) -> Column:
    return F.when(remaining <= reserve, "rate_limited").otherwise("active")


def grantable(remaining: Column, reserve: int) -> Column:
    """Credits that may still be spent; null where the remaining number is unknown."""
    return F.when(remaining.isNotNull(), F.greatest(remaining - reserve, F.lit(0)))


def normalize_link(text: Column) -> Column:
    """Without white space at its ends, line breaks included, and then with two blanks turned into one."""
    return F.replace(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""), F.lit("  "), F.lit(" "))


def absolute_url(src: Column, base: str) -> Column:
    return F.when(F.startswith(src, F.lit("http")), src).otherwise(F.concat(F.lit(base), src))


def is_item_link(href: Column, part: str = "/card/") -> Column:
    return F.contains(href, F.lit(part)) & ~F.startswith(href, F.lit("http"))


def l2_normalize(vector: Column) -> Column:
    """A vector of length 1; the zero vector unchanged."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.when(norm == 0.0, F.transform(vector, lambda x: x.cast("double"))).otherwise(F.transform(vector, lambda x: x.cast("double") / norm))


def quantize(vector: Column) -> Column:
    """-1 .. 1 to 0 .. 255, rounding halves to even."""
    return F.transform(vector, lambda x: F.least(F.greatest(F.bround((x.cast("double") + 1.0) * 127.5), F.lit(0.0)), F.lit(255.0)).cast("int"))


def pack_bytes(numbers: Column) -> Column:
    """0 .. 255 each to a byte."""
    return F.unhex(F.array_join(F.transform(numbers, lambda x: F.lpad(F.hex(x), 2, "0")), ""))


def contrast_stretch(vector: Column, low: Column, high: Column) -> Column:
    """low .. high to 0 .. 255, cut off and truncated; unchanged unless high is above low."""

    def stretched(x: Column) -> Column:
        return F.floor(F.least(F.greatest((x.cast("double") - low) * 255.0 / (high - low), F.lit(0.0)), F.lit(255.0))).cast("double")

    return F.when(high <= low, F.transform(vector, lambda x: x.cast("double"))).otherwise(F.transform(vector, stretched))


#: Brightness and contrast variants, as |a * x + b| cut off at 255.
PHOTOMETRIC = {"original": (1.0, 0.0), "brighter": (1.0, 30.0), "darker": (1.0, -30.0), "contrast": (1.2, 0.0)}


def photometric_variants(vector: Column) -> Column:
    """An array of struct<variant, vector>; dark values reflect at 0."""

    def changed(a: float, b: float) -> Column:
        return F.transform(vector, lambda x: F.least(F.abs(x.cast("double") * a + b), F.lit(255.0)))

    return F.array(*(F.struct(F.lit(n).alias("variant"), changed(a, b).alias("vector")) for n, (a, b) in PHOTOMETRIC.items()))


def tokens(text: Column) -> Column:
    """Distinct lower-case words of letters and digits."""
    return F.array_distinct(F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != ""))
