"""Line dedup by distinct-site spread: lines that stand on many sites are boilerplate.

Per line hash, HyperLogLog sketches of its sites are merged by aggregation. Estimates
clear of the threshold decide; lines near it get exact distinct counts. A document that
was copied spreads its lines over sites too. So sites are counted twice: over all
documents, which gives widely spread lines, and then over the documents that consist of
such lines to at most a half. A footer still stands on many sites there; the lines of a
copy do not, and are left to the near-duplicate operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import SPACES, numbered, renamed, stored, text_or_empty


def _line_key(line: Column) -> Column:
    return F.xxhash64(F.trim(line, F.lit(SPACES)))


def _lines(text: str) -> Column:
    return F.split(text_or_empty(text), "\n")


def _solid(text: str) -> Column:
    """Hashes of the lines with a character that is not white space."""
    return F.transform(F.filter(_lines(text), lambda x: F.length(F.trim(x, F.lit(SPACES))) > 0), _line_key)


def _site(site: str) -> Column:
    """Hash of the site; null is a site of its own."""
    return F.xxhash64(F.coalesce(F.concat(F.lit("s"), F.col(f"`{site}`").cast("string")), F.lit("null")))


def widely_spread(pairs: DataFrame, min_sites: int, lg_k: int = 10) -> DataFrame:
    """(line,) of (line, site) rows with at least min_sites distinct sites.

    A sketch per line decides where its estimate is more than four standard errors away
    from the threshold, an exact distinct count elsewhere.
    """
    sketch = pairs.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("s"))
    found = stored(sketch.select("line", F.hll_sketch_estimate("s").alias("sites")).where("sites > 1"), "lines-estimates")
    error = 4 * 1.04 / 2 ** (lg_k / 2)
    clear = F.col("sites") >= min_sites * (1 + error)
    near = found.where(~clear & (F.col("sites") >= min_sites * (1 - error)))
    exact = pairs.join(near.select("line"), "line").groupBy("line", "site").agg(F.lit(1).alias("one")).groupBy("line").agg(F.count("*").alias("n"))
    return found.where(clear).select("line").unionByName(exact.where(F.col("n") >= min_sites).select("line"))


def _bad_lines(rows: DataFrame, key: str, text: str, site: str, min_sites: int, own_share: float, lg_k: int) -> DataFrame:
    """(id, of, bad): per distinct id and text (by its hash ``of``), the hashes of its boilerplate lines."""
    keys = rows.select(F.col(key).alias("id"), "mark", _site(site).alias("site"), _solid(text).alias("keys")).where("size(keys) > 0")
    flat = keys.select("site", F.explode(F.array_distinct("keys")).alias("line"))
    # a line on one site only is left out by comparing minimum and maximum before sketches are built
    wide = flat.groupBy("line").agg(F.min("site").alias("s0"), F.max("site").alias("s1")).where("s0 <> s1").select("line")
    pairs = stored(flat.join(stored(wide, "lines-wide"), "line").groupBy("line", "site").agg(F.lit(1).alias("one")).select("line", "site"), "lines-spread")
    spread = stored(widely_spread(pairs, min_sites, lg_k), "lines-candidates")

    each = keys.select("id", F.col("mark").alias("of"), "site", F.size("keys").alias("n"), F.posexplode("keys").alias("at", "line"))
    hits = each.join(spread, "line").groupBy("id", "of").agg(
        F.max("n").alias("n"), F.collect_set("site").alias("sites"), F.collect_set(F.struct("at", "line")).alias("found")
    )  # bounded by the lines of one text, and by the number of sites
    hits = hits.select("id", "of", "sites", F.array_distinct("found.line").alias("lines"), (F.size("found") <= own_share * F.col("n")).alias("own"))
    hits = stored(hits, "lines-hits")
    evidence = hits.where("own").select(F.explode("sites").alias("site"), "lines").select("site", F.explode("lines").alias("line"))
    bad = stored(widely_spread(evidence, min_sites, lg_k), "lines-boilerplate")
    return hits.select("id", "of", F.explode("lines").alias("line")).join(bad, "line").groupBy("id", "of").agg(F.collect_set("line").alias("bad"))


def _stripped(
    docs: DataFrame, text: str, key: str, site: str, min_sites: int = 8, own_share: float = 0.5, lg_k: int = 10
) -> tuple[DataFrame, str]:
    """Numbered rows of docs with the boilerplate cut, and n_lines, n_cut; the name of the text column.

    Only hashes of lines meet the tables of lines; per distinct text, the bad hashes
    found in it come back and the text is filtered by them.
    """
    rows, (of_key, of_text, of_site) = numbered(docs, key, text, site)
    rows = rows.withColumn("mark", F.xxhash64(of_text))
    bad = stored(_bad_lines(rows, of_key, of_text, of_site, min_sites, own_share, lg_k), "lines-bad")
    rows = rows.join(bad, F.col(of_key).eqNullSafe(F.col("id")) & (F.col("mark") == F.col("of")), "left")
    lines = _lines(of_text)
    kept = F.when(F.col("bad").isNull(), lines).otherwise(F.filter(lines, lambda x: ~F.array_contains("bad", _line_key(x))))
    rows = rows.withColumn("n_lines", F.size(lines).cast("long")).withColumn("kept", kept).withColumn("n_cut", F.col("n_lines") - F.size("kept"))
    return rows.withColumn(of_text, F.when(F.col("n_cut") > 0, F.array_join("kept", "\n")).otherwise(F.col(of_text))), of_text


def line_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", site: str = "source", **settings) -> DataFrame:
    """Every row of docs, boilerplate lines cut from its text, with n_lines and n_cut.

    Boilerplate is a line on at least ``min_sites`` sites, counted over the documents of
    whose lines at most ``own_share`` are on that many sites over all documents.
    Lines are compared without white space at their ends; lines of white space are
    never boilerplate and stay. A null text stays null (one empty line); a text of
    boilerplate only becomes empty; repeated rows count once per site and are cut alike; a null site is a site of its own; ids may be null. Input columns named
    n_lines or n_cut are replaced, others pass. An empty table gives an empty result.
    """
    rows, _ = _stripped(docs, text, key, site, **settings)
    return renamed(rows, docs, "n_lines", "n_cut")


def cut_boilerplate(docs: DataFrame, text: str = "text", key: str = "doc_id", site: str = "source", length: str = "n_chars", **settings) -> DataFrame:
    """docs with the boilerplate cut; only the columns of docs, `length` (where there is one) set anew for changed texts."""
    rows, of_text = _stripped(docs, text, key, site, **settings)
    if length in docs.columns:
        at = f"c{docs.columns.index(length)}"
        changed = F.when(F.col("n_cut") > 0, F.length(of_text)).otherwise(F.col(at)).cast(docs.schema[length].dataType)
        rows = rows.withColumn(at, changed)
    return renamed(rows, docs)
