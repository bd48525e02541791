"""Evaluation: the baseline label parser, parsing and mapping metrics, dictionary mappers and
grouped averages (X15, A10-A16, J18-J20, E1-E4).

Parsers and mappers run on **distinct** inputs and are joined back, so their cost follows
the vocabulary, not the number of samples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelcorpus.functions.columns import normalize_text


# X15 ---------------------------------------------------------------------------------------
def _strip_ws(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _strip_item(s: Column) -> Column:
    """White space around the item and then final dots go. ``$`` also matches before a last line mark that is no ``\\s``; only then
    the patterns are needed."""
    marks = s.contains("\u0085") | s.contains("\u2028") | s.contains("\u2029")
    return F.when(marks, F.regexp_replace(_strip_ws(s), r"\.+$", "")).otherwise(
        F.rtrim(F.btrim(s, F.lit(" \t\n\x0b\f\r")), F.lit(".")))


def _parse_prefix(text: Column) -> Column:
    t = F.regexp_replace(text, r"(?i)^INGREDIENTS:\s*", "")
    t = F.regexp_replace(t, r"\.\s+", ", ")
    t = F.regexp_replace(t, r"(?i)CONTAINS 2%\s*OR\s*LESS\s*OF:\s*", "")
    t = F.regexp_replace(t, r"(?i)CONTAINS:?\s*.*?$", "")
    return F.regexp_replace(_strip_ws(t), r"\.+$", "")


def _split_top_level(t: Column) -> Column:
    """Split on commas outside parentheses in one left-to-right pass over comma segments.

    The accumulator carries the paren depth and the items so far; a segment is appended to
    the current item while the depth before its comma is not zero.
    """
    segs = F.split(t, ",", -1)
    init = F.struct(F.lit(0).alias("d"), F.array().cast("array<string>").alias("items"),
                    F.lit(True).alias("new"))

    def step(acc, s):
        opens = F.length(s) - F.length(F.replace(s, F.lit("("), F.lit("")))
        closes = F.length(s) - F.length(F.replace(s, F.lit(")"), F.lit("")))
        items = F.when(acc["new"], F.concat(acc["items"], F.array(s))).otherwise(
            F.concat(F.slice(acc["items"], 1, F.size(acc["items"]) - 1),
                     F.array(F.concat(F.try_element_at(acc["items"], F.lit(-1)), F.lit(","), s))))
        d = acc["d"] + opens - closes
        return F.struct(d.alias("d"), items.alias("items"), (d == 0).alias("new"))
    return F.aggregate(segs, init, step, lambda acc: acc["items"])


def _clean_items(items: Column) -> Column:
    # a lambda evaluates its argument's expression at every use, so the stripped items are an array of their own
    def clean(s):
        cut = F.instr(s, "(")
        return F.when(s.contains("(") & (cut > 1), _strip_ws(F.substring(s, F.lit(1), cut - 1))).otherwise(s)
    return F.filter(F.transform(F.transform(items, _strip_item), clean), lambda s: s != "")


def parse_ingredients(text: Column) -> Column:
    """Baseline parser: label text -> ordered ingredient names.

    Drops the INGREDIENTS prefix (anchored at the text start), turns '. ' into ', ', drops the
    2% marker, cuts the last line from its first CONTAINS, strips final dots, then splits on
    commas outside parentheses and keeps the part before '(' when it is not at the start.
    For columns holding long texts prefer ``parse_column``, which evaluates each step once.
    """
    t = _parse_prefix(text)
    return F.when(text.isNull() | (text == "") | (t == ""), F.array().cast("array<string>")) \
        .otherwise(_clean_items(_split_top_level(t)))


def parse_column(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """``parse_ingredients`` as stepwise projections (each intermediate computed once)."""
    empty = F.array().cast("array<string>")
    return (df.withColumn("_pt", _parse_prefix(F.coalesce(F.col(text_col), F.lit(""))))
            .withColumn("_pi", F.when(F.col("_pt") == "", empty)
                        .otherwise(_split_top_level(F.col("_pt"))))
            .withColumn(out_col, _clean_items(F.col("_pi")))
            .drop("_pt", "_pi"))


# A15 / A16 ---------------------------------------------------------------------------------
def _norm_list(c: Column) -> Column:
    return F.filter(F.transform(c, lambda s: normalize_text(s)), lambda s: s != "")


def set_sizes(gt_l: Column, pr_l: Column) -> list[Column]:
    """Sizes of both sets of names, of their intersection and of their union, and how many places of the lists agree."""
    gt, pr = F.array_distinct(gt_l), F.array_distinct(pr_l)
    same = F.zip_with(gt_l, pr_l, lambda a, b: a == b)  # null where one list has ended
    return [F.size(gt), F.size(pr), F.size(F.array_intersect(gt, pr)), F.size(F.array_union(gt, pr)), F.coalesce(F.size(F.filter(same, lambda x: x)), F.lit(0))]


def parsing_metrics(truth: Column, predicted: Column, normalized: bool = False, sizes: list[Column] | None = None) -> dict[str, Column]:
    """Set metrics (precision, recall, f1, exact, IoU) and order accuracy, 4 dp half-even. ``sizes``: ``set_sizes`` as columns."""
    gt_l, pr_l = (truth, predicted) if normalized else (_norm_list(truth), _norm_list(predicted))
    n_gt, n_pr, n_ok, union, matches = sizes or set_sizes(gt_l, pr_l)
    both_empty = (n_gt == 0) & (n_pr == 0)
    p = F.when(n_pr > 0, n_ok / n_pr).otherwise(F.lit(0.0))
    r = F.when(n_gt > 0, n_ok / n_gt).otherwise(F.lit(0.0))
    f1 = F.when(p + r > 0, 2.0 * p * r / (p + r)).otherwise(F.lit(0.0))
    exact = F.when((n_ok == n_gt) & (n_ok == n_pr), F.lit(1.0)).otherwise(F.lit(0.0))
    iou = F.when(union > 0, n_ok / union).otherwise(F.lit(1.0))
    order = F.when(F.greatest(F.size(gt_l), F.size(pr_l)) > 0,
                   matches / F.greatest(F.size(gt_l), F.size(pr_l))).otherwise(F.lit(1.0))

    def r4(x):
        return F.when(both_empty, F.lit(1.0)).otherwise(F.bround(x.cast("double"), 4))
    return {"precision": r4(p), "recall": r4(r), "f1": r4(f1), "exact_match": r4(exact),
            "iou": r4(iou), "order_accuracy": F.bround(order.cast("double"), 4),
            "n_ground_truth": n_gt, "n_predicted": n_pr, "n_correct": n_ok,
            "order_correct_positions": F.when(F.greatest(F.size(gt_l), F.size(pr_l)) > 0, matches)
            .otherwise(F.lit(0))}


def evaluate_parsing(samples: DataFrame, truth_col: str = "truth_names",
                     text_col: str = "ingredient_text", parser=None) -> DataFrame:
    """Per-sample parsing metrics. ``parser`` maps a text column to an array column
    (a built-in expression or an Arrow ``pandas_udf``); the default is the baseline parser."""
    if parser is None:
        samples = parse_column(samples, text_col, "_pred")
    else:
        samples = samples.withColumn("_pred", parser(F.coalesce(F.col(text_col), F.lit(""))))
    # Normalise both lists once; the metrics below only reference these columns.
    samples = samples.withColumn("_gl", _norm_list(F.col(truth_col))).withColumn(
        "_pl", _norm_list(F.col("_pred")))
    sizes = [f"_s{i}" for i in range(5)]
    samples = samples.withColumns(dict(zip(sizes, set_sizes(F.col("_gl"), F.col("_pl")))))
    m = parsing_metrics(F.col("_gl"), F.col("_pl"), True, [F.col(c) for c in sizes])
    return samples.select("*", *[v.alias(k) for k, v in m.items()]).drop("_pred", "_gl", "_pl", *sizes)


# J19 ---------------------------------------------------------------------------------------
def build_dictionary(pairs: DataFrame) -> DataFrame:
    """(key, value, pos) from ordered (pos, standard, commercial) pairs.

    Each pair writes lower(commercial) -> standard, then lower(standard) -> standard; a later
    write replaces the value but keeps the key's first position.
    """
    writes = pairs.select(F.inline(F.array(
        F.struct((F.col("pos") * 2).alias("w"), F.lower("commercial").alias("key"),
                 F.col("standard").alias("value")),
        F.struct((F.col("pos") * 2 + 1).alias("w"), F.lower("standard").alias("key"),
                 F.col("standard").alias("value")))))
    return writes.groupBy("key").agg(F.min("w").alias("pos"), F.max_by("value", "w").alias("value"))


def custom_dictionary(pairs: DataFrame) -> DataFrame:
    """(key, value, pos) from user (pos, name, value) pairs, keys lower-cased."""
    w = pairs.select(F.lower("name").alias("key"), "value", "pos")
    return w.groupBy("key").agg(F.min("pos").alias("pos"), F.max_by("value", "pos").alias("value"))


def _tokens(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.trim(c), r"\s+"), lambda t: t != ""))


# J18 ---------------------------------------------------------------------------------------
def dictionary_mapper(names: DataFrame, dictionary: DataFrame, k: int = 5,
                      name_col: str = "name") -> DataFrame:
    """(name, rank, candidate): exact lower-case hit, else the first k dictionary entries (in
    dictionary order) sharing any whitespace word. Exact without all-pairs: every token keeps
    only its first k entries (a bounded per-token list, limited map-side), and a name's first
    k matches are always among the union of its tokens' lists."""
    q = names.select(name_col).distinct().withColumn("_low", F.lower(name_col))
    exact = (q.join(dictionary, q["_low"] == dictionary["key"])
             .select(name_col, F.lit(1).alias("rank"), F.col("value").alias("candidate")))
    rest = q.join(dictionary.select("key"), q["_low"] == dictionary["key"], "left_anti")
    dtok = dictionary.select("pos", "value", F.explode(_tokens(F.col("key"))).alias("tok"))
    top = (dtok.withColumn("_r", F.row_number().over(Window.partitionBy("tok").orderBy("pos")))
           .where(F.col("_r") <= k).drop("_r"))
    qtok = rest.select(name_col, F.explode(_tokens(F.col("_low"))).alias("tok"))
    cand = qtok.join(top, "tok").select(name_col, "pos", "value").distinct()
    ranked = (cand.withColumn("rank", F.row_number().over(Window.partitionBy(name_col).orderBy("pos")))
              .where(F.col("rank") <= k).select(name_col, "rank", F.col("value").alias("candidate")))
    return exact.unionByName(ranked)


# J20 ---------------------------------------------------------------------------------------
def overlap_mapper(names: DataFrame, dictionary: DataFrame, k: int = 5,
                   name_col: str = "name", salts: int = 16) -> DataFrame:
    """(name, rank, candidate): top k entries by word-set Jaccard (score > 0), ties in
    dictionary order.

    Entries with the same word set tie everywhere, so only the first k of each set are indexed.
    One plan for names and entries of any length: the index has one row per (word, set), names
    with the same word set are one row, and an overlap is a count of common words, summed map-side.
    A word's index rows are dealt over ``salts`` keys by set, so a word that a third of the sets have
    is no single task.
    """
    q = (names.select(name_col).distinct()
         .withColumn("_qt", F.array_sort(_tokens(F.lower(name_col)))).where(F.size("_qt") > 0))
    d = (dictionary.withColumn("_dt", F.array_sort(_tokens(F.col("key")))).where(F.size("_dt") > 0)
         .withColumn("_r", F.row_number().over(Window.partitionBy("_dt").orderBy("pos")))
         .where(F.col("_r") <= k).select("pos", "value", "_dt"))
    sets = d.groupBy("_dt").agg(F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("_e")) \
        .withColumn("_id", F.xxhash64("_dt")).withColumn("nd", F.size("_dt"))
    asked = q.select("_qt").distinct().withColumn("nq", F.size("_qt"))
    salt = F.pmod(F.xxhash64("_dt"), F.lit(salts)).alias("_s")
    index = sets.select("_dt", "nd", F.explode("_dt").alias("tok"), salt)
    probe = asked.select("_qt", "nq", F.explode("_qt").alias("tok")) \
        .withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).withColumn("_s", F.col("_s").cast("bigint"))
    over = (probe.join(index, ["tok", "_s"]).groupBy("_qt", "nq", "_dt", "nd")
            .agg(F.count(F.lit(1)).alias("_o"))
            .withColumn("score", F.col("_o") / (F.col("nq") + F.col("nd") - F.col("_o"))))
    best = over.join(sets.select("_dt", F.explode("_e").alias("e")), "_dt").select("_qt", "score", "e.pos", "e.value")
    w = Window.partitionBy("_qt").orderBy(F.col("score").desc(), "pos")
    top = best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return q.join(top, "_qt").select(name_col, "rank", F.col("value").alias("candidate"))


# A14 ---------------------------------------------------------------------------------------
def mapping_metrics(truth: DataFrame, predictions: DataFrame, k: int = 5,
                    sample_col: str = "sample_id") -> DataFrame:
    """Per sample: recall@k, MRR, exact-match rate, n (ids normalised; empty truth -> 0).

    ``truth``: (sample, key, name, target); ``predictions``: (name, rank, candidate).
    """
    preds = predictions.groupBy("name").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "candidate"))),
        lambda s: normalize_text(s["candidate"])).alias("_cands"))
    # every distinct (name, target) is scored once: a name that a third of the samples share is
    # one row on the side of the predictions, and the scores meet the samples by an ordinary join
    kinds = truth.select("name", "target").distinct()
    j = kinds.join(preds, "name", "left").withColumn(
        "_cands", F.coalesce("_cands", F.array().cast("array<string>")))
    tgt = normalize_text(F.col("target").cast("string"))
    pos = F.array_position("_cands", tgt)
    scores = j.select(F.col("name").alias("_n"), F.col("target").alias("_t"),
                      F.when(F.try_element_at("_cands", F.lit(1)) == tgt, 1.0).otherwise(0.0).alias("_exact"),
                      F.when(F.array_position(F.slice("_cands", 1, k), tgt) > 0, 1.0).otherwise(0.0)
                      .alias("_hit"),
                      F.when(pos > 0, 1.0 / pos).otherwise(0.0).alias("_rr"))
    counts = truth.groupBy(sample_col, "name", "target").agg(F.count(F.lit(1)).alias("_c"))
    per = counts.join(scores, F.col("name").eqNullSafe(F.col("_n"))
                      & F.col("target").eqNullSafe(F.col("_t")))
    return per.groupBy(sample_col).agg(
        *[F.bround(F.sum(F.col(c) * F.col("_c")) / F.sum("_c"), 4).alias(out) for c, out in
          (("_hit", f"recall_at_{k}"), ("_rr", "mrr"), ("_exact", "exact_match_rate"))],
        F.sum("_c").alias("n_ingredients"))


# E2 / E4 -----------------------------------------------------------------------------------
def evaluate_mapping(samples: DataFrame, truth: DataFrame, predictions: DataFrame, k: int = 5,
                     sample_col: str = "sample_id") -> DataFrame:
    """Mapping metrics for every sample of ``samples``; one without truth rows scores 0 with n = 0.

    """
    scored = mapping_metrics(truth, predictions, k, sample_col)
    numbers = [c for c in scored.columns if c != sample_col]
    return samples.select(sample_col).distinct().join(scored, sample_col, "left").fillna(0, numbers)


# A10-A13 -----------------------------------------------------------------------------------
def average_metrics(per_sample: DataFrame, metrics: list[str], by: list | None = None) -> DataFrame:
    """Mean of per-sample metrics, 4 dp half-even, optionally grouped."""
    aggs = [F.bround(F.avg(m), 4).alias(m) for m in metrics] + \
        [F.count(F.lit(1)).alias("n_samples")]
    return per_sample.groupBy(*(by or [])).agg(*aggs)


def evaluation_summary(parsing: DataFrame | None, mapping: DataFrame | None,
                       parsing_metrics_cols: list[str], mapping_metrics_cols: list[str],
                       parser_name: str = "", mapper_name: str = "") -> DataFrame:
    """Averages of both evaluations, sample counts and names, as one row."""
    cols = []
    for df, metrics, prefix in ((parsing, parsing_metrics_cols, "parsing"),
                                (mapping, mapping_metrics_cols, "mapping")):
        if df is None:
            cols.append(F.lit(0).cast("long").alias(f"n_{prefix}"))
            continue
        cols += [df.agg(F.bround(F.avg(m), 4)).scalar().alias(f"{prefix}_{m}") for m in metrics]
        cols.append(df.agg(F.count(F.lit(1))).scalar().alias(f"n_{prefix}"))
    spark = (parsing if parsing is not None else mapping).sparkSession
    return (spark.range(1).select(*cols)
            .withColumn("n_samples", F.greatest("n_parsing", "n_mapping"))
            .withColumn("parser", F.lit(parser_name)).withColumn("mapper", F.lit(mapper_name)))


def grouped_report(tasks: dict[str, tuple[DataFrame, list[str]]], keys: DataFrame, sample_col: str = "sample_id") -> DataFrame:
    """A10-A13 in one pass: the averages of every task (parsing, mapping, ...) over all samples, by difficulty and by operator set.

    ``tasks``: name -> (per-sample metrics, metric columns); ``keys``: (sample, difficulty, operator_set). One row per task,
    ``grouping`` (``all``, ``difficulty``, ``operators``) and key, with n_samples and the metrics (null where the task has no
    such metric). The tasks' rows are one union; grouping sets expand it once and are combined before the shuffle, so
    what is shuffled is as small as the number of groups.
    """
    metrics = list(dict.fromkeys(m for _, cols in tasks.values() for m in cols))
    rows = None
    for name, (df, cols) in tasks.items():
        one = df.select(F.col(sample_col).alias("_id"), F.lit(name).alias("task"), *[
            (F.col(m).cast("double") if m in cols else F.lit(None).cast("double")).alias(m) for m in metrics])
        rows = one if rows is None else rows.unionByName(one)
    rows = rows.join(keys.select(F.col(sample_col).alias("_id"), F.col("difficulty").cast("string").alias("difficulty"),
                                 "operator_set"), "_id", "left")
    sets = [["task"], ["task", "difficulty"], ["task", "operator_set"]]
    out = rows.groupingSets(sets, "task", "difficulty", "operator_set").agg(
        F.grouping("difficulty").alias("_d"), F.grouping("operator_set").alias("_o"),
        F.count(F.lit(1)).alias("n_samples"), *[F.bround(F.avg(m), 4).alias(m) for m in metrics])
    by = F.when(F.col("_d") == 0, "difficulty").when(F.col("_o") == 0, "operators").otherwise("all")
    key = F.when(F.col("_d") == 0, F.col("difficulty")).when(F.col("_o") == 0, F.col("operator_set")).otherwise(F.lit(""))
    return out.select("task", by.alias("grouping"), key.alias("key"), "n_samples", *metrics)


def operator_set_key(records: DataFrame, sample_col: str = "food_id") -> DataFrame:
    """A12 key: sorted applied operator names joined with ','."""
    return records.groupBy(sample_col).agg(
        F.array_join(F.array_sort(F.collect_list("operator_name")), ",").alias("operator_set"))


# A17 ---------------------------------------------------------------------------------------
def pilot_audit(samples: DataFrame, declared: DataFrame, splits: DataFrame,
                id_col: str = "food_id", long_name: int = 35) -> DataFrame:
    """Ingredient count range and mean, long names, names with commas, ids in >1 split."""
    counts = declared.groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
    c = counts.agg(F.min("n").alias("min_ingredients"), F.max("n").alias("max_ingredients"),
                   F.bround(F.avg("n"), 2).alias("mean_ingredients"))
    names = declared.agg(
        F.count_if(F.length("declared_name") > long_name).alias("long_names"),
        F.count_if(F.instr("declared_name", ",") > 0).alias("names_with_commas"))
    leaks = (splits.groupBy(id_col).agg(F.countDistinct("split").alias("k"))
             .agg(F.count_if(F.col("k") > 1)))
    return c.select(samples.agg(F.count(F.lit(1))).scalar().alias("n_samples"), "*",
                    names.select("long_names").scalar().alias("long_names"),
                    names.select("names_with_commas").scalar().alias("names_with_commas"),
                    leaks.scalar().alias("ids_in_several_splits"))
