"""Mapping of landed JSON items to typed rows: every item is parsed once, with the fields that its map needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

#: The fields of landed items, their columns, and the columns' types where they aren't text.
#: A path with a dot is a field of an object; ``json`` keeps any value as its JSON text.
CATALOG_SET = {
    "id": "id",
    "name": "name",
    "series": "series",
    "printedTotal": "printed_total int",
    "total": "total int",
    "ptcgoCode": "ptcgo_code",
    "releaseDate": "release_date",
    "images.symbol": "symbol_url",
    "images.logo": "logo_url",
}
CATALOG_CARD = {
    "id": "id",
    "name": "name",
    "set.id": "set_id",
    "number": "card_number",
    "supertype": "supertype",
    "subtypes": "subtypes list",
    "hp": "hp",
    "types": "types list",
    "rarity": "rarity",
    "images.large": "image_large",
    "images.small": "image_small",
    "artist": "artist",
    "flavorText": "flavor_text",
    "regulationMark": "regulation_mark",
    "evolvesFrom": "evolves_from",
    "evolvesTo": "evolves_to list",
    "rules": "rules list",
    "abilities": "abilities list",
    "attacks": "attacks list",
    "weaknesses": "weaknesses list",
    "resistances": "resistances list",
    "retreatCost": "retreat_cost list",
    "convertedRetreatCost": "converted_retreat_cost int",
    "legalities": "legalities json",
    "tcgplayer.url": "tcgplayer_url",
    "tcgplayer.prices": "tcgplayer_prices json",
}
JA_SET = {
    "id": "id",
    "name": "name",
    "serie.name": "series",
    "cardCount.official": "printed_total int",
    "cardCount.total": "total int",
    "releaseDate": "release_date",
    "logo": "logo_url",
    "symbol": "symbol_url",
}
JA_CARD = {
    "id": "id",
    "name": "name",
    "set.id": "set_id",
    "localId": "card_number",
    "category": "supertype",
    "stage": "subtypes",
    "hp": "hp",
    "types": "types list",
    "rarity": "rarity",
    "image": "image_large",
    "illustrator": "artist",
    "description": "flavor_text",
    "regulationMark": "regulation_mark",
    "evolveFrom": "evolves_from",
    "dexId": "dex_ids json",
}
TRACKER_SET = {
    "id": "ppt_id",
    "tcgPlayerId": "tcg_player_id",
    "tcgPlayerNumericId": "tcg_player_numeric_id int",
    "name": "name",
    "series": "series",
    "releaseDate": "release_date date",
    "cardCount": "card_count int",
    "imageCdnUrl": "image_cdn_url",
    "imageCdnUrl200": "image_cdn_url_200",
    "imageCdnUrl400": "image_cdn_url_400",
    "imageCdnUrl800": "image_cdn_url_800",
    "imageUrl": "image_url",
    "priceGuideUrl": "price_guide_url",
    "hasPriceGuide": "has_price_guide boolean",
    "noPriceGuideReason": "no_price_guide_reason",
    "createdAt": "api_created_at timestamp",
    "updatedAt": "api_updated_at timestamp",
}
TRACKER_CARD = {
    "id": "ppt_id",
    "tcgPlayerId": "tcg_player_id",
    "setId": "set_numeric_id int",
    "setName": "set_name",
    "name": "name",
    "cardNumber": "card_number",
    "rarity": "rarity",
    "cardType": "card_type",
    "pokemonType": "pokemon_type",
    "energyType": "energy_type json",
    "flavorText": "flavor_text",
    "hp": "hp",
    "stage": "stage",
    "attacks": "attacks json",
    "weakness": "weakness json",
    "resistance": "resistance json",
    "retreatCost": "retreat_cost",
    "artist": "artist",
    "tcgPlayerUrl": "tcg_player_url",
    "prices.market": "price_market decimal(18,4)",
    "prices.low": "price_low decimal(18,4)",
    "prices.listings": "listings int",
    "prices.sellers": "sellers int",
    "prices.primaryPrinting": "primary_printing",
    "prices.lastUpdated": "price_last_updated timestamp",
    "prices.priceWasCorrected": "price_was_corrected boolean",
    "variants": "variants json",
    "printingsAvailable": "printings_available json",
    "imageCdnUrl": "image_cdn_url",
    "imageCdnUrl200": "image_cdn_url_200",
    "imageCdnUrl400": "image_cdn_url_400",
    "imageCdnUrl800": "image_cdn_url_800",
    "imageUrl": "image_url",
    "externalCatalogId": "external_catalog_id",
    "needsDetailedScrape": "needs_detailed_scrape boolean",
    "dataCompleteness": "data_completeness",
    "lastScrapedAt": "last_scraped_at timestamp",
    "createdAt": "api_created_at timestamp",
    "updatedAt": "api_updated_at timestamp",
}
OFFLINE_CARD = {
    "id": "id",
    "name": "name",
    "set.name": "set_name",
    "number": "card_number",
    "hp": "hp",
    "set.id": "set_id",
    "set.ptcgoCode": "set_code",
    "images.large": "image_url",
    "images.small": "image_small",
    "rarity": "rarity",
    "types": "types list",
    "set.printedTotal": "printed_total int",
}
TRACKER_VARIANTS = {"tcgPlayerId": "card_tcg_player_id", "variants": "variants json"}
VARIANT = {"marketPrice": "market_price double", "lowPrice": "low_price double", "conditionUsed": "condition_used"}


def read_items(df: DataFrame, fields: dict[str, str], item: str = "item") -> DataFrame:
    """``df`` with a column for each field of its JSON items.

    A value that doesn't fit its column's type becomes null; a list that is
    missing, or isn't one, is null, its elements are text or JSON.
    """
    tops: dict[str, list[str]] = {}
    for path in fields:
        top, _, sub = path.partition(".")
        tops.setdefault(top, []).append(sub)
    kind = lambda subs: "STRING" if subs == [""] else "STRUCT<" + ", ".join(f"`{s}`: STRING" for s in subs) + ">"
    schema = ", ".join(f"`{top}` {kind(subs)}" for top, subs in tops.items())
    parsed = df.withColumn("_parsed", F.from_json(item, schema))
    columns = {}
    for path, to in fields.items():
        name, _, type_ = to.partition(" ")
        value = F.col("_parsed")
        for part in path.split("."):
            value = value[part]
        columns[name] = S.text_array(value) if type_ == "list" else value.try_cast(type_) if type_ not in ("", "json") else value
    return parsed.select(*df.columns, *(c.alias(n) for n, c in columns.items()))


def _filled(column: str) -> Column:
    """An empty list for none."""
    return F.coalesce(F.col(column), F.array().cast("array<string>"))


def _columns(fields: dict[str, str]) -> list[str]:
    return [to.partition(" ")[0] for to in fields.values()]


def map_sets_catalog(df: DataFrame, item: str = "item") -> DataFrame:
    """Set rows from JSON objects in camel case; a missing name is ''."""
    read = read_items(df.select(item), CATALOG_SET, item)
    return read.withColumn("name", F.coalesce("name", F.lit(""))).select(*_columns(CATALOG_SET))


def map_cards_catalog(df: DataFrame, item: str = "item") -> DataFrame:
    """Card rows; missing lists are empty, the price map stays JSON ({} if missing), ``market_price`` is its best price."""
    read = read_items(df.select(item), CATALOG_CARD, item)
    lists = {n: _filled(n) for n, _, t in (to.partition(" ") for to in CATALOG_CARD.values()) if t == "list"}
    read = read.withColumns(lists | {"name": F.coalesce("name", F.lit("")), "tcgplayer_prices": F.coalesce("tcgplayer_prices", F.lit("{}"))})
    return read.select(*_columns(CATALOG_CARD), S.best_catalog_price(F.col("tcgplayer_prices")).alias("market_price"))


def _webp(url: str, ending: str) -> Column:
    return F.when(F.coalesce(url, F.lit("")) != "", F.concat(F.col(url), F.lit(ending)))


def map_sets_ja(df: DataFrame, item: str = "item") -> DataFrame:
    read = read_items(df.select(item), JA_SET, item)
    read = read.withColumns({"name": F.coalesce("name", F.lit("")), "logo_url": _webp("logo_url", ".webp"), "symbol_url": _webp("symbol_url", ".webp")})
    return read.select(*_columns(JA_SET), F.lit("ja").alias("language"))


def map_cards_ja(df: DataFrame, item: str = "item") -> DataFrame:
    """The stage becomes a list of one or none; hp becomes text, 0 and '' become null; prices are 0.

    ``dex_ids`` are the numbers that ``english_names`` looks up; null unless they are a list of whole numbers.
    """
    read = read_items(df.select(item), JA_CARD, item).withColumn("image_small", _webp("image_large", "/low.webp"))
    stage, hp = F.coalesce("subtypes", F.lit("")), F.coalesce("hp", F.lit(""))
    changed = {
        "name": F.coalesce("name", F.lit("")),
        "subtypes": F.when(stage != "", F.array(stage)).otherwise(F.array().cast("array<string>")),
        "hp": F.when(~hp.isin("", "0"), hp),
        "types": _filled("types"),
        "image_large": _webp("image_large", "/high.webp"),
        "dex_ids": F.from_json("dex_ids", "array<int>"),
    }
    return read.withColumns(changed).select(*_columns(JA_CARD), "image_small", F.lit(0.0).alias("market_price"), F.lit("ja").alias("language"))


def _stamped(read: DataFrame, language: str, columns: list[str], raw: str) -> DataFrame:
    return read.select(F.lit(language).alias("language"), *columns, F.col(raw).alias("raw"), F.current_timestamp().alias("synced_at"))


def map_sets_tracker(df: DataFrame, language: str, item: str = "item") -> DataFrame:
    read = read_items(df.select(item), TRACKER_SET, item).withColumn("name", F.coalesce("name", F.lit("")))
    return _stamped(read, language, _columns(TRACKER_SET), item)


def map_cards_tracker(df: DataFrame, language: str, item: str = "item") -> DataFrame:
    """A missing id or name is ''; hp and retreat cost are whole numbers or null; lists that aren't arrays are null."""
    read = read_items(df.select(item), TRACKER_CARD, item)
    lists = {n: S.text_array(F.col(n)) for n in ("energy_type", "attacks", "printings_available")}
    numbers = {n: S.to_int_strict(F.col(n)) for n in ("hp", "retreat_cost")}
    read = read.withColumns(lists | numbers | {n: F.coalesce(n, F.lit("")) for n in ("tcg_player_id", "name")})
    return _stamped(read, language, _columns(TRACKER_CARD), item)


def map_cards_offline(df: DataFrame, item: str = "item") -> DataFrame:
    """Rows of the offline catalog; a missing name is 'Unknown', a missing number ''."""
    read = read_items(df.select(item), OFFLINE_CARD, item)
    changed = {
        "name": F.coalesce("name", F.lit("Unknown")),
        "card_number": S.display_number(F.coalesce("card_number", F.lit("")), F.col("printed_total")),
        "image_url": F.coalesce("image_url", "image_small"),
        "types": S.join_types(F.col("types")),
        "updated_at": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
    }
    return read.withColumns(changed).drop(item, "printed_total", "image_small")


def compact_projection(df: DataFrame, columns: list[str], vector: str = "embedding", packed: str = "quantized") -> DataFrame:
    """The chosen columns and the quantised vector; nothing else."""
    return df.select(*columns, S.quantize(F.col(vector)).alias(packed))


def explode_price_variants(df: DataFrame, language: str, item: str = "item") -> DataFrame:
    """One row per card and printing; cards without id, variants that aren't an object, and entries that aren't one are left out."""
    cards = read_items(df.select(item), TRACKER_VARIANTS, item).drop(item)
    cards = cards.where("card_tcg_player_id <> '' AND startswith(ltrim(variants), '{')")
    entries = cards.select("card_tcg_player_id", F.explode(F.map_entries(F.from_json("variants", "map<string,string>"))).alias("e"))
    entries = entries.select("card_tcg_player_id", F.col("e.key").alias("printing"), F.col("e.value").alias("raw")).where("startswith(ltrim(raw), '{')")
    read = read_items(entries, VARIANT, "raw")
    return _stamped(read, language, ["card_tcg_player_id", "printing", *_columns(VARIANT)], "raw")
