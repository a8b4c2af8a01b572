"""A parent's children come as one whole list."""

from streamloom.catalog import QUERIES


def test_a_nation_has_all_its_customers_in_one_list(spark, tmp_path):
    customers = [(i * 700, f"c{i}", 3 if i % 2 else 5) for i in range(12)]
    spark.createDataFrame(customers, "c_custkey bigint, c_name string, c_nationkey int").write.parquet(str(tmp_path / "customer.parquet"))
    spark.createDataFrame([(i, f"n{i}", 0) for i in range(4)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(str(tmp_path / "nation.parquet"))
    out = QUERIES["step_association"](spark, str(tmp_path)).collect()
    want = {n + 2: [(key, name) for key, name, nation in customers if nation == n + 2] for n in range(4)}
    assert len(out) == 4 and {r.cid: [tuple(s) for s in r.students] for r in out} == want
