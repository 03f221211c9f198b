"""Mixed layouts, legacy members, label sidecars, wide panels and digests, on small files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tideline.operators import bars, quality
from tideline.sources import dated, labels


def _pruned(df):
    """Files that the scans of a plan read, after it ran."""
    df.collect()
    scans = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(scans.apply(i).metrics().apply("numFiles").value() for i in range(scans.size()) if scans.apply(i).metrics().contains("numFiles"))


def test_mixed_layouts_take_dates_from_paths_and_skip_files(spark, tmp_path):
    root = str(tmp_path)
    one = lambda x, extra="": spark.range(1).select(F.lit(x).alias("x"), *([F.lit(extra).alias("trade_date")] if extra else [])).coalesce(1)
    one(1).write.parquet(f"{root}/data/trade_date=20240105")
    one(2).write.parquet(f"{root}/data/trade_date=2024-01-06")
    for x, name in ((3, "20240107"), (4, "2024-01-08")):
        one(x).write.parquet(f"{root}/t{x}")
        part = next(p for p in os.listdir(f"{root}/t{x}") if p.endswith(".parquet"))
        os.makedirs(f"{root}/named", exist_ok=True)
        os.rename(f"{root}/t{x}/{part}", f"{root}/named/{name}.parquet")
    one(5, "20240109.0").write.parquet(f"{root}/own")
    one(6, "2024-01-10").write.parquet(f"{root}/data/trade_date=20240111")
    df = dated.read_dated(spark, root)
    assert sorted(tuple(r) for r in df.select("x", "trade_date").collect()) == [(x, dt.date(2024, 1, d)) for x, d in ((1, 5), (2, 6), (3, 7), (4, 8), (5, 9), (6, 10))]
    some = dated.read_dated(spark, root, first="2024-01-06", last="2024-01-07")
    assert sorted(r["x"] for r in some.collect()) == [2, 3]
    # the two files of those days, and the one without a date in its path
    assert _pruned(dated.read_dated(spark, root, first="2024-01-06", last="2024-01-07")) == 3 and _pruned(dated.read_dated(spark, root)) == 6


def _member(path, text, charset="gb18030"):
    path.write_bytes(text.encode(charset))
    return str(path)


def test_members_of_two_headers_give_one_typed_table(spark, tmp_path):
    a = _member(tmp_path / "a.csv", '编号,代码,量,备注\n1,000001,5,"深, ""圳"""\n2,600000,-7,\n')
    b = _member(tmp_path / "b.csv", "Code,ID,Volume,\n000002,3,9,x\n")
    aliases = {"编号": "id", "ID": "id", "代码": "code", "Code": "code", "量": "volume", "Volume": "volume", "备注": "note"}
    out = dated.read_members(spark, [a, b], aliases, ["id", "code"])
    assert dict(out.dtypes) == {"id": "bigint", "code": "string", "volume": "bigint", "note": "string"}
    assert sorted(tuple(r) for r in out.select("id", "code", "volume", "note").collect()) == [(1, "000001", 5, '深, "圳"'), (2, "600000", -7, ""), (3, "000002", 9, None)]
    assert dict(dated.read_members(spark, [a, b], aliases, ["id"], as_text=("id",)).dtypes)["id"] == "string"
    loose = _member(tmp_path / "c.csv", "ID,Code,Volume\n4,x,\n5,y,1.0\n")
    assert dict(dated.read_members(spark, [a, b, loose], aliases, ["id"]).dtypes)["volume"] == "string"
    for header in ("ID,ID\n1,2\n", "ID,,x\n1,2,3\n", "\n", "ID,编号\n1,2\n", "ID,_time\n1,2\n", "other\n1\n"):
        with pytest.raises(ValueError):
            dated.read_members(spark, [_member(tmp_path / "bad.csv", header)], aliases, ["id"])


def test_labels_meet_their_rows_by_file_and_place(spark, tmp_path):
    rows = [(7, "A", 1, 1.0), (7, "A", 1, -1.0), (7, None, 1, 2.0), (None, "A", 1, 3.0), (7, "B", 1, 4.0)]
    for k in range(2):  # the same ids in both files
        spark.createDataFrame([(*r, k * 10 + i) for i, r in enumerate(rows)], "id int, code string, t int, price double, n int").coalesce(1).write.mode("append").parquet(f"{tmp_path}/raw")
    labels.write_labels(spark, f"{tmp_path}/raw", f"{tmp_path}/labels", "deal", code="code", time="t", price="price", event_id="id")
    held = spark.read.parquet(f"{tmp_path}/labels")
    assert held.count() == 6 and {r["reason"] for r in held.collect()} == {"special_price_or_event", "missing_required_value", "missing_event_id"}
    read = lambda **k: sorted((r["n"], r["decision"]) for r in labels.read_labelled(spark, f"{tmp_path}/raw", f"{tmp_path}/labels", **k).collect())
    assert read() == [(0, "keep"), (1, "tag"), (4, "keep"), (10, "keep"), (11, "tag"), (14, "keep")]
    assert read(drop=("tag", "exclude")) == [(0, "keep"), (4, "keep"), (10, "keep"), (14, "keep")]
    assert len(read(drop=())) == 10


def test_wide_panels_stand_side_by_side(spark, tmp_path):
    rows = [(d, s, 10.0 * d + s) for d in range(3) for s in range(7) if (d + s) % 4] + [(9, None, 1.0)]
    folders = bars.wide_panel(spark.createDataFrame(rows, "d int, s int, x double"), "d", "s", "x", f"{tmp_path}/w", width=3)
    out = {r["d"]: r.asDict() for r in bars.side_by_side(spark, folders, "d").collect()}
    assert len(folders) == 3 and out == {d: {"d": d} | {f"s_{s}": 10.0 * d + s if (d + s) % 4 and d < 9 else None for s in range(7)} for d in (0, 1, 2, 9)}


def test_digests_see_each_change(spark):
    df = spark.createDataFrame([(i, f"t{i}" if i % 3 else None) for i in range(30)], "k int, s string")
    mark = lambda x: tuple(quality.content_digest(x, {"k": F.col("k").cast("string"), "s": F.col("s")}, []).first())
    assert mark(df) == mark(df.repartition(7).orderBy(F.desc("k")))
    changed = [df.where("k <> 3"), df.union(df.where("k = 3")), df.withColumn("s", F.coalesce("s", F.lit(""))), df.withColumn("s", F.when(F.col("k") == 4, "t5").otherwise(F.col("s"))), df.withColumn("k", F.when(F.col("k") == 3, 4).when(F.col("k") == 4, 3).otherwise(F.col("k")))]
    assert len({mark(x) for x in [df, *changed]}) == 6
