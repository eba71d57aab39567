"""Pieces of mapped batches."""

from tokenloom.operators import udf


def test_mappers_get_bounded_pieces(spark):
    def size(b):
        b["n"] = len(b)
        return b[["id", "n"]]

    for mapper in (udf.map_rows, udf.map_batches):
        rows = mapper(spark.range(0, 3000, 1, 1), size, "id long, n long").collect()
        assert sorted(r["id"] for r in rows) == list(range(3000))
        assert max(r["n"] for r in rows) <= 256


def test_a_piece_holds_all_rows_that_a_batch_has_of_a_key(spark):
    def count(b):
        return b.groupby("id", dropna=False).size().reset_index(name="n")

    df = spark.range(0, 3000, 1, 1).selectExpr("nullif(id % 1000, 7) AS id")
    rows = udf.map_batches(df, count, "id long, n long", key="id").collect()
    assert sorted((-1 if r["id"] is None else r["id"], r["n"]) for r in rows) == [(-1, 3), *((i, 3) for i in range(1000) if i != 7)]
