"""One surviving record for each group of duplicates, by token-level consensus."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ambitus.session import cut

from .canonical_match import words_of

#: Records of one group that are aligned in one task; the profiles of such parts are then aligned.
RECORDS_PER_PART = 200


def _score(column: dict[str, float], other: dict[str, float]) -> float:
    """How well two columns of weighted tokens agree, from 0 to 1."""
    a, b = sum(column.values()), sum(other.values())
    return sum(min(w / a, other[t] / b) for t, w in column.items() if t in other) if a and b else 0.0


def align(left: list[dict[str, float]], right: list[dict[str, float]]) -> list[dict[str, float]]:
    """Two profiles merged into one: columns that agree are joined in order, the others stay between them."""
    n, m = len(left), len(right)
    gain = [[0.0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            s = _score(left[i], right[j])
            gain[i][j] = max(gain[i + 1][j], gain[i][j + 1], gain[i + 1][j + 1] + s if s > 0 else 0.0)
    out: list[dict[str, float]] = []
    i = j = 0
    while i < n and j < m:
        s = _score(left[i], right[j])
        if s > 0 and gain[i][j] == gain[i + 1][j + 1] + s:
            joined = dict(left[i])
            for t, w in right[j].items():
                joined[t] = joined.get(t, 0.0) + w
            out.append(joined)
            i, j = i + 1, j + 1
        elif gain[i][j] == gain[i + 1][j]:
            out.append(left[i])
            i += 1
        else:
            out.append(right[j])
            j += 1
    return out + left[i:] + right[j:]


def progressive(profiles: list[list[dict[str, float]]]) -> list[dict[str, float]]:
    """All profiles aligned one after the other, the heaviest first."""
    profiles = sorted(profiles, key=lambda p: (-sum(sum(c.values()) for c in p), str(p)))
    out = profiles[0] if profiles else []
    for p in profiles[1:]:
        out = align(out, p)
    return out


def consensus(profile: list[dict[str, float]], total: float, share: float = 0.5) -> list[str]:
    """The token with the most votes of each column, for columns that at least this share of the weight has."""
    out = []
    for column in profile:
        token, weight = max(column.items(), key=lambda x: (x[1], x[0]))
        if sum(column.values()) >= share * total and weight > 0:
            out.append(token)
    return out


def token_distance(a: list[str], b: list[str]) -> float:
    """Edits of whole tokens between two lists, as a share of the longer one."""
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y)))
        prev = row
    return prev[-1] / max(len(a), len(b), 1)


class Fields:
    """How the fields of a record become tokens and what their consensus is.

    texts: words; a column of the alignment stays if half of the weight has it.  filled: one token if the flag is set; sets: their
    elements in order.  Both speak for information: a column stays if any record has it.  latest and lowest: the value is one
    token whose vote outweighs every later (earlier) one put together, so that only the best one has to be kept."""

    def __init__(self, texts: list[str], filled: list[str] = (), sets: list[str] = (), latest: list[str] = (), lowest: list[str] = ()):
        self.texts, self.filled, self.sets, self.latest, self.lowest = list(texts), list(filled), list(sets), list(latest), list(lowest)
        self.judged = [*self.filled, *self.sets, *self.latest, *self.lowest]
        self.names = [*self.texts, *self.judged]

    def columns(self, df: DataFrame) -> list[Column]:
        """All fields in a form that Python reads without conversion: texts as they are, flags and sets as arrays of texts, ordered
        values as whole numbers (a timestamp in microseconds)."""
        none = F.array().cast("array<string>")
        out = [F.col(c).cast("string").alias(c) for c in self.texts]
        out += [F.when(F.col(c), F.array(F.lit("filled"))).otherwise(none).alias(c) for c in self.filled]
        out += [F.coalesce(F.array_sort(F.array_distinct(F.array_compact(F.col(c).cast("array<string>")))), none).alias(c) for c in self.sets]
        for c in [*self.latest, *self.lowest]:
            kind = df.schema[c].dataType
            value = F.unix_micros(F.col(c).cast("timestamp")) if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)) else F.col(c).cast("long")
            out.append(value.alias(c))
        return out

    def tokens(self, record: dict, field: str) -> list[str]:
        value = record[field]
        if field in self.texts:
            return words_of(value) if value else []
        return list(value) if value is not None else []

    def profile(self, records: list[dict]) -> dict:
        """The aligned profile of each field; records hold the fields and their weight."""
        out: dict = {"": sum(r["weight"] for r in records)}
        for f in [*self.texts, *self.filled, *self.sets]:
            weights: dict[tuple, float] = {}
            for r in records:
                t = tuple(self.tokens(r, f))
                if t:
                    weights[t] = weights.get(t, 0.0) + r["weight"]
            out[f] = progressive([[{w: x} for w in t] for t, x in weights.items()])
        for f, best in [(f, max) for f in self.latest] + [(f, min) for f in self.lowest]:
            out[f] = best((int(r[f]) for r in records if r[f] is not None and r[f] == r[f]), default=None)
        return out

    def decide(self, profiles: list[dict]) -> dict:
        """The consensus: tokens of each text, flag and set, and the winning value of each ordered field."""
        total = sum(p[""] for p in profiles)
        out: dict = {}
        for f in [*self.texts, *self.filled, *self.sets]:
            out[f] = consensus(progressive([p[f] for p in profiles if p[f]]), total, 0.5 if f in self.texts else 0.0)
        for f, best in [(f, max) for f in self.latest] + [(f, min) for f in self.lowest]:
            out[f] = best((p[f] for p in profiles if p[f] is not None), default=None)
        return out

    def distance(self, record: dict, agreed: dict) -> float:
        """Whole tokens in which the judged fields differ from the consensus, and beyond the point the mean share of words in
        which the texts do (halved, so that it is less than one token)."""
        far = 0.0
        for f in [*self.filled, *self.sets]:
            mine, theirs = self.tokens(record, f), agreed[f]
            far += round(token_distance(mine, theirs) * max(len(mine), len(theirs), 1))
        for f in [*self.latest, *self.lowest]:
            mine = None if record[f] is None or record[f] != record[f] else int(record[f])
            far += mine != agreed[f]
        return far + 0.5 * sum(self.text_distance(record, f, agreed) for f in self.texts) / max(1, len(self.texts))

    def text_distance(self, record: dict, field: str, agreed: dict) -> float:
        """A missing text is as far as can be, unless the consensus is empty as well."""
        mine = self.tokens(record, field)
        return token_distance(mine, agreed[field]) if mine or not agreed[field] else 1.0


def group_consensus(rows: DataFrame, fields: Fields, records_per_part: int = RECORDS_PER_PART) -> DataFrame:
    """(group, agreed): the consensus of each group as JSON.  rows: group, key, weight and the fields as of ``Fields.columns``.

    Records are dealt by a hash of their key to parts of about records_per_part; a part's values are aligned progressively, then
    the profiles of the parts, so that no task holds all records of a group: a profile has one entry a distinct word of a column."""

    @F.pandas_udf("string")
    def profile(records: pd.Series) -> pd.Series:
        return pd.Series([json.dumps(fields.profile(list(rs))) for rs in records], dtype=object)

    @F.pandas_udf("string")
    def decide(profiles: pd.Series) -> pd.Series:
        return pd.Series([json.dumps(fields.decide([json.loads(p) for p in ps])) for ps in profiles], dtype=object)

    n = rows.groupBy("group").agg(F.ceil(F.count("*") / F.lit(records_per_part)).cast("int").alias("_parts"))
    parts = rows.join(n, "group").withColumn("_part", F.pmod(F.xxhash64("key"), F.col("_parts")))
    made = parts.groupBy("group", "_part").agg(F.sort_array(F.collect_list(F.struct("key", "weight", *fields.names))).alias("_records")).select("group", profile("_records").alias("_profile"))
    return made.groupBy("group").agg(F.sort_array(F.collect_list("_profile")).alias("_profiles")).select("group", decide("_profiles").alias("agreed"))


def _prepared(records: DataFrame, group: str, key: str, fields: Fields, weight: Column | None) -> DataFrame:
    w = (weight if weight is not None else F.lit(1.0)).cast("double").alias("weight")
    rows = records.where(F.col(group).isNotNull() & F.col(key).isNotNull())
    return rows.select(F.col(group).alias("group"), F.col(key).alias("key"), w, F.struct(*fields.columns(records)).alias("_f")).select("group", "key", "weight", *[F.col("_f")[c].alias(c) for c in fields.names]).distinct()


def survivors(records: DataFrame, group: str, key: str, texts: list[str], filled: list[str], sets: list[str], latest: list[str], lowest: list[str], weight: Column | None = None, records_per_part: int = RECORDS_PER_PART, agree=group_consensus) -> DataFrame:
    """(group, key, survivor, distance): every record of each group of two or more keys with its group's survivor.

    texts: text columns, missing values as null.  filled: boolean columns, sets: arrays, latest: columns of which the greatest is
    best and null the worst, lowest: of which the smallest is best and null the worst; these are the judged fields.

    All fields become weighted tokens, which are aligned progressively within the group and voted on column by column (see
    ``Fields`` for how each kind votes); the row of winners is the consensus.  The survivor is the existing record that is
    closest to it: fewest differing tokens of the judged fields, then of the words of the texts, then the smallest key.  A record
    that no other beats in any judged field differs from the consensus in none of them.

    A null group or key is left out; a key given twice counts once if its rows are equal, else the closer row speaks for it; a
    group of one key is no group.  agree: what makes the consensus (for tests of what it decides)."""
    fields = Fields(texts, filled, sets, latest, lowest)
    rows = _prepared(records, group, key, fields, weight)
    several = rows.groupBy("group").agg(F.min("key").alias("_lo"), F.max("key").alias("_hi")).where("_lo <> _hi").select("group")
    rows = cut(rows.join(several, "group", "left_semi"))
    agreed = agree(rows, fields, records_per_part)

    @F.pandas_udf("double")
    def distance(record: pd.DataFrame, agreed: pd.Series) -> pd.Series:
        return pd.Series([fields.distance(r, json.loads(a)) for r, a in zip(record.to_dict("records"), agreed)], dtype="float64")

    far = cut(rows.join(agreed, "group").select("group", "key", F.round(distance(F.struct(*fields.names), "agreed"), 9).alias("distance")).groupBy("group", "key").agg(F.min("distance").alias("distance")))
    chosen = far.groupBy("group").agg(F.min_by("key", F.struct("distance", "key")).alias("survivor"))
    return far.join(chosen, "group").select(F.col("group").alias(group), F.col("key").alias(key), "survivor", "distance")


def merged(records: DataFrame, group: str, key: str, texts: list[str], weight: Column | None = None, records_per_part: int = RECORDS_PER_PART) -> DataFrame:
    """(group, each text): for each group and field the existing value that is closest to the field's consensus, the first in order
    among equally close ones; null where no record of the group has a value."""
    fields = Fields(texts)
    rows = cut(_prepared(records, group, key, fields, weight))
    agreed = group_consensus(rows, fields, records_per_part)

    @F.pandas_udf("array<double>")
    def distances(record: pd.DataFrame, agreed: pd.Series) -> pd.Series:
        return pd.Series([[round(fields.text_distance(r, f, a), 9) for f in fields.texts] for r, a in zip(record.to_dict("records"), map(json.loads, agreed))], dtype=object)

    far = rows.join(agreed, "group").select("group", *fields.names, distances(F.struct(*fields.names), "agreed").alias("_d"))
    best = [F.min(F.when(F.col(f).isNotNull(), F.struct(F.col("_d")[i].alias("d"), F.col(f).alias("v"))))["v"].alias(f) for i, f in enumerate(fields.texts)]
    return far.groupBy("group").agg(*best).withColumnRenamed("group", group)


__all__ = ["Fields", "align", "consensus", "group_consensus", "merged", "progressive", "survivors"]
