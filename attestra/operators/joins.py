"""Joins between items, ledgers, registries, caches and files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestra.functions.columns import as_col
from attestra.functions.text import norm_name
from attestra.functions.urls import is_ipfs, probe_url, url_key


#: Rows of the bit table that keeps rows without a partner out of a shuffle: fixed, 64 bits each.
BIT_ROWS = 1 << 17


def maybe_met(rows: DataFrame, named: DataFrame, key: str) -> DataFrame:
    """Rows whose 64-bit ``key`` ``named`` may hold; rows that it does not hold for sure go before any shuffle, all others stay.

    A bit for every key of ``named`` in a table of at most ``BIT_ROWS`` rows whatever the input, so it can always be broadcast. Null keys go.
    """
    word, bit = F.floor(F.pmod(F.col(key), F.lit(BIT_ROWS * 64)) / 64), F.pmod(F.col(key), F.lit(64)).cast("int")
    table = named.groupBy(word.alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_bits"))
    return rows.withColumn("_word", word).join(F.broadcast(table), "_word").filter(F.getbit("_bits", bit) == 1).drop("_word", "_bits")


def _name_set(df: DataFrame, key: str, names: str) -> DataFrame:
    """Normalised names in one row per key, as a sorted set."""
    norm = df.select(key, F.explode(names).alias("_n")).select(key, norm_name("_n").alias("_n")).filter("_n <> ''")
    return norm.groupBy(key).agg(F.array_sort(F.collect_set("_n")).alias("_set"))


def match_token_sets(queries: DataFrame, registry: DataFrame, query_key: str, entry_key: str, names: str = "names", hints: int = 8) -> DataFrame:
    """Registry entry whose set of names equals the asked set; none or several are errors, with partial overlaps as hints."""
    q, e = _name_set(queries, query_key, names), _name_set(registry, entry_key, names)
    from attestra.operators.ranking import first_rows
    # entries shrink to one row a set, so a set that many share costs no pair of query and entry
    sets = e.groupBy("_set").agg(F.count(entry_key).alias("_n"), F.min(entry_key).alias("_e"))
    exact = q.join(sets, "_set", "left").groupBy(query_key).agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("matches"), F.min("_e").alias("_entry"))
    lost = exact.filter("matches = 0").select(query_key)
    parts = q.join(lost, query_key, "left_semi").select(query_key, F.explode("_set").alias("_n"))
    # the first entries of a query are among the first of its names
    named = first_rows(e.select(entry_key, F.explode("_set").alias("_n")).distinct(), ["_n"], [entry_key], hints)
    near = parts.join(named, "_n").select(query_key, entry_key).distinct()
    hint = first_rows(near, [query_key], [entry_key], hints).groupBy(query_key).agg(F.array_sort(F.collect_list(entry_key)).alias("hints"))
    status = F.when(F.col("matches") == 1, "ok").when(F.col("matches") == 0, "none").otherwise("ambiguous")
    return exact.join(hint, query_key, "left").select(query_key, "matches", F.when(F.col("matches") == 1, F.col("_entry")).alias(entry_key), status.alias("status"), "hints")


def skip_reviewed(items: DataFrame, ledger: DataFrame, item_key: str, section: str | None = None) -> DataFrame:
    """Items whose key is not marked reviewed."""
    done = ledger.filter("reviewed")
    if section is not None:
        done = done.filter(F.col("section") == section)
        return items.join(done.select(F.col("entry_key").alias(item_key)), item_key, "left_anti")
    return items.join(done.select("section", F.col("entry_key").alias(item_key)), ["section", item_key], "left_anti")


def unpulled_links(links: DataFrame, pulled: DataFrame, by: Sequence[str] = (), url: str = "url") -> DataFrame:
    """Links the data bundle did not download already (exact URL)."""
    done = pulled.select(*by, F.trim(F.col(url)).alias(url))
    return links.join(done, [*by, url], "left_anti")


def uncrawled(links: DataFrame, manifest: DataFrame, url: str = "url") -> DataFrame:
    """URLs without a successful crawl, the trailing slash ignored."""
    done = manifest.filter("success").select(url_key(url).alias("_key"))
    return links.withColumn("_key", url_key(url)).join(done, "_key", "left_anti").drop("_key")


def attach_reachability(links: DataFrame, probes: DataFrame, url: str = "url", checked: bool = True) -> DataFrame:
    """Reachability per link: unreachable ipfs links drop out, other unknown links count as "no"."""
    if not checked:
        return links.withColumn("http_accessible", F.lit("no"))
    seen = probes.select(F.col("checked_url").alias("_probe"), F.col("accessible").alias("_ok"))
    joined = links.withColumn("_probe", probe_url(url)).join(seen, "_probe", "left")
    ok = F.coalesce("_ok", F.lit("no"))
    return joined.filter(~is_ipfs(url) | (ok == "yes")).withColumn("http_accessible", ok).drop("_probe", "_ok")


def cache_split(needed: DataFrame, cache: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Distinct needed keys that the cache holds, and those it lacks."""
    keys = needed.select(key).filter(as_col(key).isNotNull()).distinct()
    return keys.join(cache, key, "left_semi"), keys.join(cache, key, "left_anti")


def attach_line_meta(lines: DataFrame, meta: DataFrame, key: str = "line_id") -> DataFrame:
    """Weights and cluster data back onto validated lines; lines without get cluster 1 of size 1."""
    m = meta.select(key, "cluster_id", "cluster_size", "effective_weight")
    return lines.join(m, key, "left").withColumns({"cluster_id": F.coalesce("cluster_id", F.lit(1)), "cluster_size": F.coalesce("cluster_size", F.lit(1))})


def append_new(df: DataFrame, stored: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows whose key the stored table lacks, within their group; rows without a key all count as new."""
    return df.join(stored.select(*by, key).filter(as_col(key).isNotNull()), [*by, key], "left_anti")


def resolve_ledger_key(reviews: DataFrame, profiles: DataFrame, papers: DataFrame) -> DataFrame:
    """Ledger section and key of an uploaded review, by route.

    reviews(review_id, route, name, parent_dir), profiles(folder, symbol, initial_symbol), papers(record_name, pdf_stem).
    """
    by_folder = profiles.select(F.col("folder").alias("_folder")).distinct()
    symbol = F.coalesce(F.nullif(F.trim("symbol"), F.lit("")), F.trim("initial_symbol"))
    by_symbol = profiles.withColumn("_symbol", symbol).filter("_symbol <> ''").groupBy("_symbol").agg(F.min("folder").alias("_by_symbol"))
    by_stem = papers.groupBy(F.col("pdf_stem").alias("_stem")).agg(F.min("record_name").alias("_record"))
    joined = (reviews.join(by_folder, F.col("name") == F.col("_folder"), "left").join(by_symbol, F.col("name") == F.col("_symbol"), "left")
              .join(by_stem, F.col("parent_dir") == F.col("_stem"), "left"))
    parent = F.nullif(F.trim("parent_dir"), F.lit(""))
    folder = F.coalesce(F.least("_folder", "_by_symbol"), parent)  # folders are scanned in name order, by name or symbol
    key = (F.when(F.col("route") == "proposal", F.when(F.startswith("parent_dir", F.lit("proposal_")), F.concat(F.lit("proposals/"), "parent_dir", F.lit(".json"))))
           .when(F.col("route") == "compounds", F.coalesce(F.nullif(F.trim("name"), F.lit("")), parent))
           .when(F.col("route") == "dao", folder).when(F.col("route") == "article", F.concat(F.lit("papers/"), "_record")))
    section = F.when(F.col("route").isin("proposal", "article"), "researchhub").when(F.col("route") == "compounds", "pumpScience").when(F.col("route") == "dao", "molecule")
    return joined.select("review_id", "route", F.when(key.isNotNull(), section).alias("section"), key.alias("entry_key"))


def missing_rows(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right, list(on), "left_anti")


