"""Secret scans: candidates by pattern, false positives removed by a random forest. Column expressions only.

A candidate is a run of at least 16 key characters, a value that a key word is assigned (of any length and alphabet), or
what has a known form: a private key block, a JWT, a known prefix, a Bearer value. Its features: length, character
transitions (class changes, distinct characters, shares of digits and capitals), dictionary coverage (characters covered
by known words), path (of the document, and path signs in the candidate) and neighbouring words (key
words, assignment, quotes, placeholder and check-sum words just before; signs just after), known form. A random forest
is trained on labelled findings and turned into a column expression of its trees' votes, so that scoring
is a projection: no explode, no shuffle, texts of any length.

Training reads at most ``fit_rows`` labelled findings of each class, those with the smallest hash, so
reruns agree. Without labels of both classes the verdict is that of the only class, or false. Findings of known form, and
without a labelled table all that the rules are sure of, are secrets whatever the forest says.

Defined cases: null or empty text has no candidates and stays as it is. A candidate in a very long text is judged
like any other. Null source or path counts as no path. Repeated rows are scanned one by one. Extra columns
pass through; an input column with the name of an output column is replaced. An empty table gives an empty
result.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, under_hash

#: The candidate pattern, the dictionary and the word lists of the features.
KEY = "A-Za-z0-9_+/-"
_WORD = (r"(?i:token(?!i)|secret(?!ar)|passw(?:or)?d|passphrase|pwd|api[_-]?key|access[_-]?key|private[_-]?key"
         r"|auth(?!or(?!i))|bearer|credential)")
OPEN = _WORD + r"[A-Za-z0-9_-]{0,20}[\"'`\]\\]{0,3}\s{0,4}(?::=|=>|[:=])\s{0,4}\\?"  # a key word and its assignment
_PLAIN, _END = r"[^\s\"'`<>&]*", r"[^\s\"'`<>&.,;:)\]}]"
ASSIGNED = (r"(?<=[\s:=>\"'`\\])(?<=[:=>]\s{0,4}\\?[\"'`]?)(?:"
            + "|".join(f"(?<={OPEN}{q})[^{q}\\r\\n]++(?={q})" for q in "\"'`")
            + rf"|(?<={OPEN}[\"'`]?)(?!(?i:bearer|basic|digest|token)\s){_PLAIN}{_END}(?:&(?![A-Za-z0-9_]{{1,40}}=){_PLAIN}{_END}){{0,200}})")
BLOCK = (r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----(?:[^-]++|-(?!----)){0,200}+"
         r"-----END [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----")
PREFIXED = (r"(?<![A-Za-z0-9])(?:eyJ[A-Za-z0-9_-]{5,}(?:\.[A-Za-z0-9_-]+){1,4}|A(?:KI|SI|BI|CC)A[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{20,}"
            r"|github_pat_[A-Za-z0-9_]{20,}|glpat-[A-Za-z0-9_-]{16,}|xox[abeoprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{30,}"
            r"|sk-(?:[a-z]{2,8}-){0,4}[A-Za-z0-9_]{16,}[A-Za-z0-9_-]*|[prs]k_(?:live|test)_[A-Za-z0-9]{10,}|hf_[A-Za-z0-9]{20,}"
            r"|npm_[A-Za-z0-9]{30,}|pypi-[A-Za-z0-9_-]{20,}|ya29\.[A-Za-z0-9_-]{20,}|SG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,})(?![A-Za-z0-9])")
HEADER = r"(?i:authorization)[\"']?\s{0,4}[:=]\s{0,4}[\"']?(?i:bearer)\s{1,4}"
MIXED = r"[A-Za-z._~+/-]*(?:[0-9]|[a-z][A-Z])"  # a digit or a capital inside tells a Bearer value from prose
BEARER = rf"(?<=\s)(?<=(?i:bearer)\s{{1,4}})(?:(?<={HEADER})[^\s\"'`]+|(?={MIXED})[A-Za-z0-9._~+/-]+={{0,2}})"
CANDIDATE = (f"{BLOCK}|(?<![A-Za-z0-9])(?:{BEARER}|{ASSIGNED}|{PREFIXED}"
             f"|(?<![{KEY}])[{KEY}]{{16,}}(?:={{1,2}}(?![\"'={KEY[:-1]}-]))?)")
DICTIONARY = (
    "the", "and", "for", "with", "that", "this", "from", "have", "are", "was", "not", "you", "all", "can",
    "tion", "ing", "ment", "able", "ness", "ance", "ight", "ould", "ther", "ally", "ous", "ent", "est",
    "user", "name", "file", "data", "test", "home", "page", "index", "image", "html", "http", "www", "com",
    "content", "version", "release", "example", "sample", "document", "report", "section", "article", "number",
    "schen", "lich", "keit", "heit", "ung", "eaux", "elle", "ción", "ado", "mente",
)
KEY_WORDS = r"(?i)(token|secret|passw(or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer|credential)"
FEATURES = ("length", "changes", "distinct", "digits", "capitals", "hexadecimal", "coverage", "in_path",
            "example_path", "key_word", "assigned", "quoted", "placeholder", "checksum", "joined", "known")
OUTPUTS = ("findings", "n_candidates", "n_secrets", "safe_text")
MASK = "[SECRET]"


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("double")


def features(core: Column, before: Column, after: Column, path: Column) -> Column:
    """The candidate's features as a struct of doubles."""
    n = F.length(core).cast("double")
    left = F.length(F.regexp_replace(F.lower(core), "(" + "|".join(DICTIONARY) + ")", ""))
    changes = F.regexp_count(core, F.lit("(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])"))
    values = {
        "length": n,
        "changes": changes / n,
        "distinct": F.size(F.array_distinct(F.split(core, ""))) / n,
        "digits": F.regexp_count(core, F.lit("[0-9]")) / n,
        "capitals": F.regexp_count(core, F.lit("[A-Z]")) / n,
        "hexadecimal": _flag(core.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
        "coverage": 1 - left / n,
        "in_path": _flag(core.rlike("/[a-z]+[/.]")),
        "example_path": _flag(path.rlike("(?i)(test|example|sample|fixture|docs?/)")),
        "key_word": _flag(before.rlike(rf"{KEY_WORDS}[^A-Za-z0-9]{{0,6}}$|{OPEN}[\"'`]?$")),
        "assigned": _flag(before.rlike(r"(?:[=:]|=>)\s{0,4}\\?[\"'`]?$")),
        "quoted": _flag(before.rlike("[\"'`]$")),
        "placeholder": _flag(before.rlike(r"(?i)(example|sample|dummy|your|placeholder)\W{1,3}\w{0,12}\W{0,4}$")),
        "checksum": _flag(before.rlike(r"(?i)(sha-?\d*|md5|commit|checksum|digest|uuid|hash|isbn)\W{0,6}$")),
        "joined": _flag(after.rlike(r"^[@.][A-Za-z]")),
        "known": _flag(core.rlike(f"{BLOCK}|{PREFIXED}") | before.rlike(HEADER + "$")
                       | (before.rlike(r"(?i)bearer\s{1,4}$") & core.rlike("^" + MIXED))),
    }
    return F.struct(*[values[f].cast("double").alias(f) for f in FEATURES])


def candidates(text: Column, path: Column) -> tuple[Column, Column, Column]:
    """Candidates, the gaps around them (one more than candidates), and the candidates' features."""
    t = F.coalesce(text, F.lit(""))
    found, gaps = F.regexp_extract_all(t, F.lit(CANDIDATE), F.lit(0)), F.split(t, CANDIDATE, -1)
    # zipped, so that no lambda refers to a whole array: the optimizer would put its regex in again for every candidate
    f, g = F.col("_found"), F.col("_gaps")
    near = F.arrays_zip(F.concat(f, F.array(F.lit(None).cast("string"))), F.concat(F.array(F.lit("")), f), F.slice(g, F.lit(1), F.size(g)),
                        F.slice(g, F.lit(2), F.size(g)))
    return found, gaps, F.transform(F.filter(near, lambda z: z["0"].isNotNull()), lambda z: features(
        z["0"], F.right(F.concat(z["1"], z["2"]), F.lit(80)), F.left(z["3"], F.lit(8)), path))


def with_candidates(docs: DataFrame, text: str, path: str | None) -> DataFrame:
    p = F.col(path) if path else F.lit(None).cast("string")
    found, gaps, facts = candidates(F.col(text), p)
    return docs.withColumns({"_found": found, "_gaps": gaps}).withColumn("_facts", facts)


def certain(f: Column) -> Column:
    """Known forms, unless they are announced as examples."""
    return (f["known"] == 1) & (f["placeholder"] == 0)


def rule_labels(f: Column) -> Column:
    """Labels for findings that are certain either way: 1, 0, or null where only the forest can tell."""
    opened = (f["key_word"] == 1) & (f["assigned"] == 1)
    sure = certain(f) | (opened & (f["coverage"] < 0.3) & (f["changes"] > 0.1))
    never = ((f["digits"] == 1) & ~(opened & (f["quoted"] == 1))) | (f["coverage"] > 0.6) | ((f["joined"] == 1) & ~opened) | (
        f["placeholder"] == 1) | ((f["changes"] < 0.1) & (f["key_word"] == 0))
    return F.when(sure, 1).when(never, 0)


def labelled_findings(docs: DataFrame, text: str = "text", path: str | None = "source") -> DataFrame:
    """Findings of ``docs`` labelled by rule (features, label): the default training set."""
    d = with_candidates(docs.filter(F.col(text).rlike(CANDIDATE)), text, path)
    # outer: no filter on the array's size is inferred, which would compute it twice
    f = d.select(F.explode_outer("_facts").alias("f"))
    return f.select("f.*", rule_labels(F.col("f")).alias("label")).filter("label is not null")


def forest(labelled: DataFrame, fit_rows: int = 5_000, trees: int = 15, depth: int = 5,
           seed: int = 7) -> Callable[[Column], Column]:
    """Train on at most ``fit_rows`` rows per class; returns features struct -> share of trees that say secret."""
    key = F.xxhash64(*FEATURES)
    labelled = stored(labelled.select(*FEATURES, "label", key.alias("_k")), "secrets-labelled")
    total = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    parts = [labelled.filter(F.col("label") == c).select(*FEATURES, F.lit(float(c)).alias("label"), "_k")
             .filter(under_hash(F.col("_k"), total.get(c, 0), fit_rows)).orderBy("_k").limit(fit_rows) for c in (0, 1)]
    fit = stored(parts[0].unionByName(parts[1]).coalesce(1), "secrets-fit")
    classes = [r["label"] for r in fit.select("label").distinct().collect()]
    if len(classes) < 2:
        return lambda f: F.lit(classes[0] if classes else 0.0)
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="v").transform(fit).select("v", "label")
    model = RandomForestClassifier(featuresCol="v", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed).fit(rows)
    said = [tree_lines(t) for t in re.split(r"\n\s*Tree \d+.*:\n", "\n" + model.toDebugString)[1:]]

    def votes(f: Column) -> Column:
        total = F.lit(0.0)
        for lines in said:
            total = total + tree_column(iter(lines), f)
        return total / len(said)
    return votes


def tree_lines(text: str) -> list[str]:
    return [x.strip() for x in text.splitlines() if x.strip()]


def tree_column(lines, f: Column) -> Column:
    """One printed tree (If ... Else ... Predict) as a nested CASE on the features."""
    line = next(lines)
    if line.startswith("Predict"):
        return F.lit(float(line.split(":")[1]))
    feature, limit = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    low = tree_column(lines, f)
    next(lines)  # the Else line repeats the test
    high = tree_column(lines, f)
    return F.when(f[FEATURES[int(feature)]] <= float(limit), low).otherwise(high)


def secret_scan(docs: DataFrame, text: str = "text", path: str | None = "source", labelled: DataFrame | None = None,
                least: float = 0.5, fit_rows: int = 5_000) -> DataFrame:
    """Add findings (number, start, finding, score, secret), counts, and the text with secrets masked."""
    d = docs.select(*[c for c in docs.columns if c not in OUTPUTS])
    votes = forest(labelled if labelled is not None else labelled_findings(d, text, path), fit_rows)
    sure = certain if labelled is not None else lambda f: F.coalesce(rule_labels(f) == 1, F.lit(False))
    d = with_candidates(d, text, path)
    d = d.withColumn("_scores", F.transform("_facts", lambda f: F.when(sure(f), 1.0).otherwise(votes(f))))
    score = lambda i: F.get(F.col("_scores"), i)
    # Each finding's place: gaps and findings before it, in one pass over both.
    none = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("starts"))
    d = d.withColumn("_starts", F.aggregate(F.arrays_zip("_gaps", "_found"), none, lambda a, z: F.struct(
        (a["at"] + F.length(z["_gaps"]) + F.coalesce(F.length(z["_found"]), F.lit(0))).alias("at"),
        F.concat(a["starts"], F.array(a["at"] + F.length(z["_gaps"]))).alias("starts")), lambda a: a["starts"]))
    d = d.withColumn("findings", F.transform("_found", lambda c, i: F.struct(
        i.alias("number"), F.get(F.col("_starts"), i).alias("start"), c.alias("finding"), F.round(score(i), 4).alias("score"),
        (score(i) > least).alias("secret"))))
    d = d.withColumns({
        "n_candidates": F.size("_found").cast("bigint"),
        "n_secrets": F.size(F.filter("_scores", lambda s: s > least)).cast("bigint")})
    masked = F.array_join(F.transform("_gaps", lambda g, i: F.concat(g, F.when(
        score(i) > least, F.lit(MASK)).otherwise(F.coalesce(F.get(F.col("_found"), i), F.lit(""))))), "")
    d = d.withColumn("safe_text", F.when(F.col("n_secrets") == 0, F.col(text)).otherwise(masked))
    return d.drop(
        "_found", "_facts", "_scores", "_gaps", "_starts")


def secret_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = "source",
                 **how) -> DataFrame:
    """One row per finding: key, number, start (characters before it), length, finding, score, secret."""
    # outer: no filter on the array's size is pushed down, where the patterns would be evaluated again for it
    d = secret_scan(docs, text, path, **how).select(key, F.explode_outer("findings").alias("f"))
    return d.filter("f IS NOT NULL").select(key, "f.number", "f.start", F.length("f.finding").alias("length"), "f.finding", "f.score", "f.secret")
