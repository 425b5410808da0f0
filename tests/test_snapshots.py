from ambitus.operators.snapshots import diff_snapshots

SCHEMA = "l string, v int, k string, name string, tags array<string>, lat double, change_kind string"


def changes(spark, rows, expected=None, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    e = spark.createDataFrame(expected, "l string, v int, n int") if expected is not None else None
    out = diff_snapshots(df, "l", "v", "k", ["name"], ["tags"], ["lat"], expected=e, expected_count="n", **kw)
    return sorted(tuple(r) for r in out.collect())


def row(v, k, name="a", tags=("x", "y"), lat=1.0, lst="L"):
    return (lst, v, k, name, list(tags) if tags is not None else None, lat, "clash")


def test_kinds(spark):
    rows = [row(1, "a"), row(1, "b"), row(1, "c"), row(1, "d", tags=None), row(1, "e"), row(1, "f", lat=None)]
    rows += [row(2, "a", tags=("y", "x", "x")), row(2, "b", name=None), row(2, "d", tags=()), row(2, "e", lat=1.0 + 2e-7), row(2, "f", lat=2.0), row(2, "g"), row(2, "a", lat=1.0 + 3e-14)]
    assert changes(spark, rows) == [("L", 2, "b", "changed"), ("L", 2, "c", "removed"), ("L", 2, "e", "changed"), ("L", 2, "f", "changed"), ("L", 2, "g", "added")]


def test_incomplete_deliveries_and_buckets(spark):
    keys = [f"k{i}" for i in range(50)]
    rows = [row(1, k) for k in keys] + [row(2, k) for k in keys[:10]] + [row(4, k) for k in keys[1:]] + [row(4, "new")] + [row(1, "only", lst="M"), row(2, "other", lst="M")]
    want = [("L", 4, "k0", "removed"), ("L", 4, "new", "added"), ("M", 2, "only", "removed"), ("M", 2, "other", "added")]
    got = changes(spark, rows, [("L", 1, 50), ("L", 2, 49), ("L", 4, None), ("L", 4, 50)], keys_per_bucket=7)
    assert sorted(got) == sorted(want)


def test_nulls_and_empty(spark):
    assert changes(spark, [row(1, None), row(None, "a"), (None, 1, "a", "a", [], 1.0, "x")]) == []
    assert changes(spark, []) == []


def test_runs_of_deliveries_and_buckets(spark):
    """However few keys a task may hold, the changes are the same: deliveries are cut into runs and keys into buckets."""
    rows = [row(v, f"k{k}", name=f"n{(v * k) % 3}") for v in range(1, 8) for k in range(12) if (v + k) % 4]
    whole = changes(spark, rows)
    assert len(whole) >= 60
    for n in (1, 5, 9, 20, 27):
        assert changes(spark, rows, keys_per_bucket=n) == whole
