"""URL filters: host and path rules first, then a path-template tree per host, judged by labelled purity.

Rules give a verdict to the URLs they fit and these are the labels of the method. Every other URL is judged by
its template:

1. A path is cut into at most ``depth`` levels (the rest is one last level). Digits and long hexadecimal runs in a
   segment become placeholders, so numbered pages are one shape.
2. Level by level, top down, a segment stays a literal branch if it has enough rows and its labelled share of blocked
   rows differs from its siblings' by more than chance (a two-proportion test), or if only it has labels; all
   other branches of a node, too small or statistically similar, are merged into one wildcard. A node with a
   single branch keeps it.
3. From the root (all hosts) over the host to the leaf, a node's purity is its share of blocked labelled rows, smoothed
   towards its parent's: ``(blocked + weight * parent) / (labelled + weight)``. A template is
   rejected if its leaf's purity is over ``reject``.

URLs are summed by (host, levels) before anything is shuffled, so a host with a third of all rows is a few rows
per shape; the rows meet their template by a join that Spark may split where it is skewed.

Defined cases: a null URL or one without ``://`` has empty host and path, fits no rule and is judged by the empty host's
template. Without any label everything unruled is allowed. Repeated rows get the same verdict. Extra
columns pass through; an input column with the name of an output column is replaced. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

OUTPUTS = ("host", "path", "rule", "template", "purity", "verdict")
#: The rules of the registered query, as (verdict, host and path prefix).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(F.coalesce(url, F.lit("")), F.lit("://"))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, as a struct (verdict, rule), or null. Of equal rules the first counts."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, start = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + start))
        out = F.when(fits & (F.coalesce(F.length(out["rule"]), F.lit(-1)) < len(rule)),
                     F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(out)
    return out


def levels(path: Column, depth: int) -> list[Column]:
    """The path's segments with placeholders, null below its end; the last level holds all that is left."""
    shape = F.regexp_replace(F.regexp_replace(path, r"[0-9a-fA-F-]*[0-9][0-9a-fA-F-]{7,}", "<id>"), r"[0-9]+", "<n>")
    parts = F.filter(F.split(shape, "/"), lambda s: s != "")
    out = [F.get(parts, F.lit(i)) for i in range(depth - 1)]
    tail = F.array_join(F.slice(parts, F.lit(depth), F.greatest(F.size(parts), F.lit(1))), "/")
    return [*out, F.when(F.size(parts) >= depth, tail)]


def template_tree(shapes: DataFrame, depth: int, least_rows: int, z: float, weight: float) -> DataFrame:
    """Templates of summed shapes (host, s0.., rows, labelled, blocked): adds t0.. and purity."""
    s = [f"s{i}" for i in range(depth)]
    t = [f"t{i}" for i in range(depth)]
    sums = lambda: [F.sum(c).alias(c) for c in ("rows", "labelled", "blocked")]
    tree = shapes
    for i in range(depth):
        node = ["host", *t[:i]]
        branch = tree.groupBy(*node, s[i]).agg(*sums())
        # a node's sums over its branches: a row per node, joined back
        whole = branch.groupBy(*node).agg(F.sum("labelled").alias("_l"), F.sum("blocked").alias("_b"), F.count("*").alias("_n"))
        both = _join(branch, whole, node)
        rest_l, rest_b = F.col("_l") - F.col("labelled"), F.col("_b") - F.col("blocked")
        share = F.try_divide  # null where there is nothing to divide by
        pooled = share("_b", "_l")
        spread = F.sqrt(pooled * (1 - pooled) * (share(F.lit(1), F.col("labelled")) + share(F.lit(1), rest_l)))
        differs = F.abs(share("blocked", "labelled") - share(rest_b, rest_l)) > z * spread
        literal = (F.col("_n") == 1) | F.col(s[i]).isNull() | (
            (F.col("rows") >= least_rows) & (F.col("labelled") > 0)
            & ((rest_l == 0) | F.coalesce(differs, F.lit(False))))
        names = both.select(*node, s[i], F.when(literal, F.col(s[i])).otherwise("*").alias(t[i]))
        tree = stored(_join(tree, names, [*node, s[i]]), "url-tree")
    prior = tree.agg(F.try_divide(F.sum("blocked"), F.sum("labelled")).alias("purity"))
    nodes = tree.groupBy("host").agg(*sums()).withColumn("purity", _smoothed(F.coalesce(prior.scalar(), F.lit(0.0)), weight))
    for i in range(depth):
        node = ["host", *t[:i]]
        below = tree.groupBy(*node, t[i]).agg(*sums())
        nodes = _join(below, nodes.select(*node, F.col("purity").alias("_p")), node).withColumn(
            "purity", _smoothed(F.col("_p"), weight)).drop("_p")
    return _join(tree.select("host", *s, *t), nodes.select("host", *t, "purity"), ["host", *t])


def _smoothed(parent: Column, weight: float) -> Column:
    return (F.col("blocked") + weight * parent) / (F.col("labelled") + weight)


def _join(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Equi join in which null equals null; b's key columns are dropped."""
    b = b.select(*[F.col(c).alias(f"_k_{c}") if c in on else F.col(c) for c in b.columns])
    cond = None
    for c in on:
        one = F.col(c).eqNullSafe(F.col(f"_k_{c}"))
        cond = one if cond is None else cond & one
    return a.join(b, cond).drop(*[f"_k_{c}" for c in on])


def url_filter(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, url: str = "url", depth: int = 4,
               least_rows: int = 5, z: float = 1.96, weight: float = 2.0, reject: float = 0.7) -> DataFrame:
    """Add host, path, rule, template, purity and verdict to every row."""
    d = pages.select(*[c for c in pages.columns if c not in OUTPUTS])
    host, path = host_and_path(F.col(url))
    s = [f"s{i}" for i in range(depth)]
    keys = ["host", *s]
    d = d.withColumns({"host": host, "path": path})
    d = d.withColumn("_rule", fitting_rule(F.col("host"), F.col("path"), rules))
    facts = d.select("host", "_rule", *[c.alias(n) for n, c in zip(s, levels(F.col("path"), depth))])
    blocked = (F.col("_rule.verdict") == "block").cast("bigint")
    shapes = stored(facts.groupBy(*keys).agg(
        F.count("*").alias("rows"), F.count("_rule.verdict").alias("labelled"),
        F.coalesce(F.sum(blocked), F.lit(0)).alias("blocked")), "url-shapes")
    tree = stored(template_tree(shapes, depth, least_rows, z, weight), "url-templates")
    text = F.concat(F.col("host"), F.concat_ws("", *[F.concat(F.lit("/"), F.col(f"t{i}")) for i in range(depth)]))
    tree = tree.select(*keys, "purity", text.alias("template"))
    d = d.withColumns(dict(zip(s, levels(F.col("path"), depth))))
    d = _join(d, tree, keys).drop(*s)
    own = F.when(F.col("purity") > reject, "block").otherwise("allow")
    return d.withColumns({"rule": F.col("_rule.rule"), "verdict": F.coalesce(F.col("_rule.verdict"), own)}).drop("_rule")
