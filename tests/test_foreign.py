"""Foreign parsers and mappers, some of whose rows fail."""

from __future__ import annotations


def test_foreign_parser_fails_on_its_rows_only(spark):
    from labelcorpus.operators import evaluate as E
    from labelcorpus.operators.foreign import evaluate_parser

    def parser(text):
        if "bad" in text:
            raise RuntimeError("no idea")
        return None if "none" in text else [1] if "number" in text else text.split(", ")
    rows = [(1, "a, b", ["A", "B"]), (2, "bad, c", ["bad", "c"]), (3, "a, b", ["a", "x"]), (4, None, []), (5, "none", ["q"]), (6, "number", ["q"])]
    got = {r["id"]: r for r in evaluate_parser(spark.createDataFrame(rows, "id int, ingredient_text string, truth_names array<string>"), parser).collect()}
    assert (got[1]["f1"], got[3]["f1"], got[1]["order_accuracy"]) == (1.0, 0.5, 1.0)
    assert got[2]["parser_error"] == "RuntimeError: no idea" and got[2]["f1"] is None and got[2]["n_predicted"] is None
    assert "TypeError" in got[5]["parser_error"] and "must be strings" in got[6]["parser_error"]
    assert got[4]["parser_error"] is None and got[4]["precision"] == 1.0
    frame = spark.createDataFrame([(g["f1"],) for g in got.values()], "f1 double")
    assert E.average_metrics(frame, ["f1"]).first()["f1"] == 0.8333


def test_foreign_mapper_is_narrowed_to_failing_names(spark):
    from labelcorpus.operators import evaluate as E
    from labelcorpus.operators.foreign import run_mapper

    def mapper(names):
        if any(n.startswith("bad") for n in names):
            raise KeyError("boom")
        return {n: [n.lower(), "other"] for n in names if n != "SKIP"}
    names = [f"N{i}" for i in range(50)] + ["bad1", "bad2", "SKIP", "N1", None]
    predictions, failures = run_mapper(spark.createDataFrame([(n,) for n in names], "name string"), mapper)
    got = {(r["name"], r["rank"]): r["candidate"] for r in predictions.collect()}
    assert len(got) == 100 and got["N7", 1] == "n7" and got["N7", 2] == "other"
    assert {r["name"]: r["error"] for r in failures.collect()} == {"bad1": "KeyError: 'boom'", "bad2": "KeyError: 'boom'"}
    truth = spark.createDataFrame([(1, "N1", "N1", "n1"), (1, "N2", "N2", "other"), (2, "bad1", "bad1", "bad1")],
                                  "sample_id int, key string, name string, target string")
    scores = {r["sample_id"]: r for r in E.evaluate_mapping(truth, truth, predictions).collect()}
    assert (scores[1]["exact_match_rate"], scores[1]["recall_at_5"], scores[2]["recall_at_5"]) == (0.5, 1.0, 0.0)


def test_custom_dictionary(spark):
    from labelcorpus.operators import evaluate as E
    pairs = spark.createDataFrame([(0, "Sea Salt", "salt"), (1, "SUGAR", "sugar"), (2, "sea salt", "salt, table")], "pos int, name string, value string")
    assert {(r["key"], r["value"], r["pos"]) for r in E.custom_dictionary(pairs).collect()} == {("sea salt", "salt, table", 0), ("sugar", "sugar", 1)}
    found = E.dictionary_mapper(spark.createDataFrame([("SEA SALT",), ("brown sugar",)], "name string"), E.custom_dictionary(pairs))
    assert {(r["name"], r["candidate"]) for r in found.collect()} == {("SEA SALT", "salt, table"), ("brown sugar", "sugar")}
