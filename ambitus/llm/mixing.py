"""Mixing of sources to target shares in tokens, with a cap on how often a document is repeated."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ambitus.session import cut

DEFAULT_TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Most sources in the table of targets: it is collected to the driver.
MAX_SOURCES = 100_000
#: Documents of one cell of the seeded order, about; the share's edge falls into one cell of each source.
CELL_DOCS = 50_000

_ENCODERS: dict[str, object] = {}


def _encoder(path: str):
    if path not in _ENCODERS:
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
        _ENCODERS[path] = tiktoken.Encoding("mix", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def token_count(text: Column, tokenizer: str = DEFAULT_TOKENIZER) -> Column:
    """Tokens of a whole text by a public byte-level tokenizer; 0 for null."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = _encoder(tokenizer)
        for texts in batches:
            yield pd.Series([len(enc.encode_ordinary(t.encode("utf-8", "replace").decode())) if isinstance(t, str) else 0 for t in texts], dtype="int64")

    return count(text)


def source_key(source: Column) -> Column:
    """Sources written differently under one key: lower case, blanks and hyphens as underscores; missing spellings as null."""
    key = F.regexp_replace(F.lower(F.trim(source)), r"[\s\-_]+", "_")
    return F.when(~key.isin("", "null", "n/a", "_", "none"), key)


def water_fill(sizes: dict[str, int], shares: dict[str, float], repeats: dict[str, int], total: float) -> dict[str, float]:
    """Tokens of each source: its share of the total, but at most repeats times its size; what a clamped source leaves is given
    to the others in proportion to their shares, until no source is over its cap or all are clamped."""
    cap = {s: float(sizes.get(s, 0)) * max(0, repeats.get(s, 0)) for s in shares}
    out: dict[str, float] = {}
    free, left = {s for s in shares if shares[s] > 0}, float(total)
    while free and left > 1e-9:
        weight = sum(shares[s] for s in free)
        over = {s for s in free if left * shares[s] / weight >= cap[s] - 1e-9}
        if not over:
            return out | {s: left * shares[s] / weight for s in free} | {s: 0.0 for s in shares if s not in out and s not in free}
        for s in over:
            out[s] = cap[s]
            left -= cap[s]
        free -= over
        left = max(left, 0.0)
    return {s: out.get(s, 0.0) for s in shares}


def mix(
    docs: DataFrame,
    doc_id: str,
    text: str,
    source: str,
    targets: DataFrame,
    total_tokens: int | None = None,
    seed: int = 17,
    tokenizer: str = DEFAULT_TOKENIZER,
    target_source: str = "source",
    target_share: str = "target_share",
    max_repeats: str = "max_repeats",
) -> tuple[DataFrame, DataFrame]:
    """(rows, report).

    rows: (doc_id, source, n_tokens, copies) of the documents used, each whole, copies at most its source's max_repeats.
    report: one row for each target source (source, target_share, available_tokens, epochs, tokens, actual_share, clamped).

    total_tokens is the size wanted; by default the tokens that the target sources hold.  A source is allotted its share; one
    whose allotment exceeds max_repeats times its size is clamped there and the excess goes to the others in proportion.  Of an
    allotment of e epochs every document is taken floor(e) times, and the rest from documents in the order of a seeded hash of
    their id, as long as the next one ends by less than half of itself beyond the allotment.  Sources that are no target, and
    documents with a null or empty text, are not used; each row of docs is a document.  A null or negative share or cap counts
    as 0; shares need not add up to 1.  Only sums by source reach the driver, and no source is ordered as a whole.
    """
    key = source_key(F.col(source))
    d = cut(docs.select(F.col(doc_id).alias("_id"), key.alias("_s"), token_count(F.col(text), tokenizer).alias("_n")).where(F.col("_n") > 0))
    t = targets.select(source_key(F.col(target_source)).alias("_s"), F.col(target_share).cast("double").alias("_share"), F.col(max_repeats).cast("int").alias("_cap")).where(F.col("_s").isNotNull())
    wanted = t.groupBy("_s").agg(F.max(F.coalesce("_share", F.lit(0.0))).alias("_share"), F.max(F.coalesce("_cap", F.lit(0))).alias("_cap")).limit(MAX_SOURCES + 1).collect()
    if len(wanted) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} target sources")
    spark = docs.sparkSession
    shares = {r["_s"]: max(0.0, r["_share"]) for r in wanted}
    caps = {r["_s"]: max(0, r["_cap"]) for r in wanted}
    names = spark.createDataFrame([(s,) for s in shares], "_s string")
    held = d.join(F.broadcast(names), "_s")  # at most MAX_SOURCES short names
    stats = {r["_s"]: (r["n"], r["docs"]) for r in held.groupBy("_s").agg(F.sum("_n").alias("n"), F.count("*").alias("docs")).collect()}
    sizes = {s: int(stats.get(s, (0, 0))[0]) for s in shares}
    total = total_tokens if total_tokens is not None else sum(sizes[s] for s in shares if shares[s] > 0)
    given = water_fill(sizes, shares, caps, total)
    plan = []
    for s in shares:
        whole = min(int(given[s] // sizes[s]), caps[s]) if sizes[s] else 0
        rest = given[s] - whole * sizes[s] if sizes[s] and whole < caps[s] else 0.0
        bits = max(0, (stats.get(s, (0, 0))[1] // CELL_DOCS).bit_length())
        plan.append((s, whole, float(rest), min(bits, 24), shares[s], sizes[s], bool(sizes[s] == 0 or given[s] >= caps[s] * sizes[s] - 1e-6)))
    p = spark.createDataFrame(plan, "_s string, _whole int, _rest double, _bits int, _share double, _size long, _clamped boolean")
    # the seeded order, cut into cells of its leading bits
    h = held.join(F.broadcast(p.select("_s", "_whole", "_rest", "_bits")), "_s").withColumn("_h", F.xxhash64("_id", F.lit(seed)))
    high = F.shiftrightunsigned(F.col("_h"), 40)  # 24 bits
    h = h.withColumn("_cell", F.floor(high / F.pow(F.lit(2.0), 24 - F.col("_bits"))).cast("long"))
    cells = h.where(F.col("_rest") > 0).groupBy("_s", "_cell", "_rest").agg(F.sum("_n").alias("_sum"))
    before = F.sum("_sum").over(Window.partitionBy("_s").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1))
    cells = cells.withColumn("_before", F.coalesce(before, F.lit(0))).select("_s", "_cell", "_before", (F.col("_before") + F.col("_sum")).alias("_after"))
    h = h.join(cells, ["_s", "_cell"], "left")
    sure = F.coalesce(F.col("_after") <= F.col("_rest"), F.lit(False))
    edge = F.coalesce((F.col("_after") > F.col("_rest")) & (F.col("_before") < F.col("_rest")), F.lit(False))
    own = Window.partitionBy("_s", "_cell").orderBy("_h", "_id").rowsBetween(Window.unboundedPreceding, 0)
    inside = h.where(edge).withColumn("_cum", F.col("_before") + F.sum("_n").over(own))
    inside = inside.withColumn("_more", (F.col("_cum") - F.col("_n") / 2.0 <= F.col("_rest")).cast("int"))
    cols = [F.col("_id"), F.col("_s"), F.col("_n")]
    rows = h.where(~edge).select(*cols, (F.col("_whole") + sure.cast("int")).alias("copies")).unionByName(inside.select(*cols, (F.col("_whole") + F.col("_more")).alias("copies")))
    rows = rows.where(F.col("copies") > 0)
    got = rows.groupBy("_s").agg(F.sum(F.col("_n") * F.col("copies")).alias("_tokens"))
    all_tokens = got.agg(F.sum("_tokens").alias("_all"))
    report = p.join(got, "_s", "left").crossJoin(F.broadcast(all_tokens)).select(  # one row
        F.col("_s").alias("source"), F.col("_share").alias("target_share"), F.col("_size").alias("available_tokens"),
        F.when(F.col("_size") > 0, F.coalesce("_tokens", F.lit(0)) / F.col("_size")).otherwise(F.lit(0.0)).alias("epochs"),
        F.coalesce("_tokens", F.lit(0)).alias("tokens"), F.when(F.col("_all") > 0, F.coalesce("_tokens", F.lit(0)) / F.col("_all")).otherwise(F.lit(0.0)).alias("actual_share"),
        F.col("_clamped").alias("clamped"),
    )
    return rows.withColumnsRenamed({"_id": doc_id, "_s": "source", "_n": "n_tokens"}), report


def repeat_rows(rows: DataFrame) -> DataFrame:
    """Each document as many times as its copies, numbered from 1 in ``copy``."""
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies")
