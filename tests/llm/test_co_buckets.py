import hashlib
import zlib
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from meridian.llm import co_buckets, queries

SF = "/root/testdata/sf0.001"


def sha(parts) -> str:
    return hashlib.sha256(",".join(parts).encode()).hexdigest()


def order(row):
    """Sort key of a row: nulls first, strings by their bytes."""
    return [(v is not None, v.encode() if isinstance(v, str) else v) for v in row]


def plain(path: str) -> Path:
    return Path("/" + path.removeprefix("file:").lstrip("/"))


def by_hand(sales: list[tuple], lines: list[tuple], item: int, n: int = 300) -> dict:
    """(table, bucket) to what the query says of its file, and its rows; the key is the first column of both."""
    crc = lambda s: zlib.crc32(s.encode()) % n
    ids = {r[0] for r in sales} - {None}
    of_sale = lambda r: n + 1 if r[0] is None else crc(f"line{r[0]}")
    of_line = lambda r: n + 1 if r[0] is None else of_sale(r) if r[0] in ids else n
    at_sale = lambda r: of_sale(r) - (of_sale(r) % 3 == 1)
    at_line = lambda r: 0 if r[item] is None else crc(str(r[item]))
    out = {}
    for name, rows, bucket, at in (("sales", sales, of_sale, at_sale), ("sale_lines", lines, of_line, at_line)):
        flows, start = {}, {}
        for r in rows:
            b, s = bucket(r), at(r)
            start.setdefault(s, set()).add(b)
            flows.setdefault(b, {}).setdefault(s, []).append(r)
        for b, by in flows.items():
            mine = sorted((r for part in by.values() for r in part), key=order)
            n_joined = sum((r[0] == x[0]) for r in sales if of_sale(r) == b for x in lines if x[0] == r[0]) if b < n else 0
            out[name, b] = (
                sha("" if r[0] is None else str(r[0]) for r in mine), sha(f"{s}:{len(by[s])}" for s in sorted(by)), len(mine), n_joined,
                not (len(by) == 1 and all(len(start[s]) == 1 for s in by)), mine,
            )
    return out


def compare(result, want):
    rows = result.collect()
    assert len({(r.table_name, r.bucket) for r in rows}) == len(rows)
    got = {(r.table_name, r.bucket): (r.ids_sha256, r.lineage_sha256, r.n_rows, r.n_joined, r.rewritten) for r in rows}
    assert got == {k: v[:-1] for k, v in want.items()}
    paths = {plain(r.path) for r in rows}
    for r in rows:
        table = pq.ParquetFile(plain(r.path)).read()
        assert ",".join(table.column_names) == r.columns
        assert [tuple(x.values()) for x in table.to_pylist()] == want[r.table_name, r.bucket][-1]
    for d in {p.parent for p in paths}:
        assert {p for p in d.iterdir() if not p.name.endswith(".crc")} == {p for p in paths if p.parent == d}


def test_the_query_against_a_version_by_hand(spark):
    sales, lines = (queries.read_table(spark, SF, t) for t in ("sales", "sale_lines"))
    want = by_hand([tuple(r) for r in sales.collect()], [tuple(r) for r in lines.collect()], lines.columns.index("item_id"))
    compare(queries.op11_co_buckets(spark, SF), want)
    assert {v[4] for v in want.values()} == {True, False}


FEW = co_buckets.Layout(6)
SALES = [(1, "b"), (1, "a"), (1, "a"), (2, None), (None, "x"), (None, None), (3, "é"), (3, "z"), (3, "Z")]
LINES = [(1, 5, 1.0), (1, 5, 1.0), (1, None, 2.0), (2, 7, None), (None, 7, 3.0), (None, None, None), (99, 5, 1.5), (98, 6, 0.5), (98, 5, float("inf"))]


@pytest.mark.parametrize("sales, lines", [(SALES, LINES), (SALES, []), ([], LINES), ([], []), (SALES[:1], LINES[3:4]), (SALES * 50, LINES * 40)])
def test_odd_rows(spark, tmp_path, sales, lines):
    a, b = spark.createDataFrame(sales, "sale_id long, bucket string"), spark.createDataFrame(lines, "sale_id long, item_id long, row double")
    result = co_buckets.sales_and_lines(a.repartition(3), b.repartition(3), f"file://{tmp_path}/x", FEW)
    compare(result, by_hand(sales, lines, 1, 6))


def test_columns_with_names_of_its_own(spark, tmp_path):
    a = spark.createDataFrame([(1, 2, 3, 4, 5)], "sale_id long, key long, file long, _metadata long, number long")
    b = spark.createDataFrame([(1, 2, 3, 4)], "sale_id long, item_id long, path long, n long")
    rows = co_buckets.sales_and_lines(a, b, f"file://{tmp_path}/x", FEW).collect()
    assert sorted(r.columns for r in rows) == ["sale_id,item_id,path,n", "sale_id,key,file,_metadata,number"]
    assert [r.n_joined for r in rows] == [1, 1]


def test_a_hot_key_is_not_paired(spark, tmp_path):
    a = spark.range(3000).select(F.lit(7).cast("long").alias("sale_id"), F.col("id").alias("x"))
    b = spark.range(50000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("sale_id"), (F.col("id") % 10).alias("item_id"))
    rows = {(r.table_name, r.bucket): r for r in co_buckets.sales_and_lines(a, b, f"file://{tmp_path}/x", FEW).collect()}
    hot = zlib.crc32(b"line7") % 6
    n = b.filter("sale_id = 7").count()
    assert rows["sale_lines", hot].n_joined == rows["sales", hot].n_joined == 3000 * n
    assert rows["sale_lines", hot].ids_sha256 == sha(["7"] * n) and rows["sale_lines", 6].n_rows == 50000 - n
