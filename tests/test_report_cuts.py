"""Reports over samples: selected rows are made once, metrics are written before they are grouped, odd texts and lists."""

from pyspark.sql import functions as F

from labelcorpus.operators import evaluate as E
from labelcorpus.plans import queries as Q
from labelcorpus.plans import report_queries as RQ


def _tables(spark, folder) -> str:
    orders = [(i, 7 + i % 2, "O", 900.0 * i, "2-HIGH") for i in range(1, 7)]
    lines = [(o, o + n, n, n, 10.0 * n + o, 50.0, 0.01 * n, 0.02) for o in range(1, 7) for n in range(1, 4)]
    parts = [(i, f"red {'bolt' if i % 2 else 'ring'}", "SMALL" if i % 3 else "PROMO") for i in range(1, 12)]
    for name, rows, schema in (
            ("orders", orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"),
            ("lineitem", lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                                "l_extendedprice double, l_discount double, l_tax double"),
            ("part", parts, "p_partkey bigint, p_name string, p_type string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_reports_read_the_selected_rows_once(spark, monkeypatch, tmp_path):
    """The metrics of each sample are written before they are grouped, and the selected rows are made once."""
    made, plain, tables = [], Q._selected, _tables(spark, tmp_path)
    monkeypatch.setattr(Q, "_selected", lambda *a: made.append(1) or plain(*a))
    report = RQ.q_evaluation_report(spark, tables)
    assert len(made) == 1
    assert [r.n_samples for r in report.where("grouping = 'all'").collect()] == [6, 6]
    grouped = Q.q_metrics_by_group(spark, tables)
    assert "regexp_replace" not in grouped._jdf.queryExecution().optimizedPlan().toString()
    assert sum(r.n_samples for r in grouped.collect()) == 6


def test_odd_items_and_lists_of_the_parser(spark):
    items = [" a. ", "b(c", "(d)", "..", "e.\u0085", "\tf \n", " g (h) "]
    got = spark.range(1).select(E._clean_items(F.array(*[F.lit(x) for x in items]))).first()[0]
    assert got == ["a", "b", "(d)", "e\u0085", "f", "g"]
    df = spark.createDataFrame([(1, "a, b, a", ["A", "b", "c", "d"]), (2, "a", None), (3, "", [])], "i int, t string, g array<string>")
    rows = {r.i: r for r in E.evaluate_parsing(df, "g", "t").collect()}
    assert (rows[1].n_correct, rows[1].order_correct_positions, rows[1].iou, rows[1].order_accuracy) == (2, 2, 0.5, 0.5)
    assert (rows[2].order_correct_positions, rows[2].order_accuracy, rows[3].iou) == (0, 0.0, 1.0)
