"""Personal data: high-recall candidates, boosted trees, calibrated selection.

Only DataFrame functions and ``pyspark.ml``.  Four base kinds are found by pattern and check.
Three generators propose wider, overlapping spans (anything around an ``@``, runs of digits, long
unbroken strings).  Gradient-boosted trees judge each candidate by format and context features
(shares of character classes, digits, separators, cue words and characters around it), never by
the checks themselves; they learn from a bounded sample (``SAMPLE_DOCS`` documents,
``SAMPLE_CANDIDATES`` candidates) whose labels are the base checks and, for strings, an assigned
random-looking value.  A logistic calibration on held-back candidates turns margins into
probabilities, and candidates of at least ``THRESHOLD`` that touch no base span are selected.

The trees become one column expression, so every row is judged where it lies: no candidate is
shuffled and no text is moved.  Offsets come from the lengths between matches, summed in blocks.

Defined cases: a null or empty text has no spans; spans of one kind never overlap, spans of
different kinds may; with too few candidates of either class nothing is added to the base spans;
null ids and repeated rows are rows like any other; an empty table gives no rows.  Columns named as
an added one (``pii_text``, ``pii_base``, ``pii_spans``, ``pii_<kind>``) are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import set_aside, written

KINDS = ("email", "ip", "card", "phone")
# fixed values: what each kind matches.  Written without backtracking: a run is entered at its
# start (or where the last match ended) and never given back, which finds the same matches.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# a row is searched for a kind only if this holds
MAY_HOLD = {"email": lambda t: F.contains(t, F.lit("@")), "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
            "card": lambda t: t.rlike(r"(?:[0-9][\x20-]?){11}[0-9]"), "phone": lambda t: t.rlike(r"\+[0-9]")}
GENERATORS = {
    "address": r"(?:\G|(?<!\S))[^\s@]*+@\S*+",
    "number": r"\+?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+",
    "secret": r"(?:\G|(?<![A-Za-z0-9_/+=-]))[A-Za-z0-9_/+=-]{20,}+",
}
GEN_MAY = {"address": lambda t: F.contains(t, F.lit("@")), "number": lambda t: t.rlike(r"[0-9](?:[\x20().-]{0,2}[0-9]){6}"),
           "secret": lambda t: t.rlike(r"[A-Za-z0-9_/+=-]{20}")}
CUES = {"secret": r"(token|secret|passw|pwd|api.?key|key|auth|bearer)", "phone": r"(tel|phone|fax|mobil|call|\+)",
        "card": r"(card|visa|iban|account|konto|cuenta|compte)", "mail": r"(mail|contact|write|@)"}
CONTEXT = 24
SAMPLE_DOCS = 40_000
SAMPLE_CANDIDATES = 20_000
THRESHOLD = 0.9
BLOCK = 128
FEATURES = ["address", "number", "secret", "length", "digits", "digit_share", "upper_share", "lower_share", "space_count", "dot_count",
            "dash_count", "at_count", "plus", "distinct_share", "hex", "mixed", "cue_secret", "cue_phone", "cue_card", "cue_mail",
            "quote_before", "assign_before", "word_before", "quote_after", "word_after"]


def located(rows: DataFrame, text: Column, searches: dict) -> DataFrame:
    """Adds, per name of ``searches`` (pattern, gate), ``pii_<name>``: matches with start and end."""
    names = list(searches)
    rows = rows.withColumns({f"pii_h_{n}": F.when(gate(text), F.regexp_extract_all(text, F.lit(p), F.lit(0))) for n, (p, gate) in searches.items()})
    rows = rows.withColumns({f"pii_s_{n}": F.when(F.size(f"pii_h_{n}") > 0, F.zip_with(
        F.slice(F.split(text, searches[n][0]), F.lit(1), F.size(f"pii_h_{n}")), F.col(f"pii_h_{n}"), lambda gap, hit: F.length(gap) + F.length(hit))) for n in names})
    add = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    rows = rows.withColumns({f"pii_b_{n}": F.when(F.col(f"pii_s_{n}").isNotNull(), F.transform(
        F.sequence(F.lit(0), F.floor((F.size(f"pii_s_{n}") - 1) / BLOCK).cast("int")), lambda b: add(F.slice(f"pii_s_{n}", b * BLOCK + 1, F.lit(BLOCK))))) for n in names})
    rows = rows.withColumns({f"pii_a_{n}": F.when(F.col(f"pii_b_{n}").isNotNull(), F.transform(
        F.sequence(F.lit(1), F.size(f"pii_b_{n}")), lambda b: add(F.slice(f"pii_b_{n}", F.lit(1), b - 1)))) for n in names})

    def span(n):
        def at(hit, i):
            b = F.floor(i / BLOCK).cast("int")
            end = F.get(f"pii_a_{n}", b) + add(F.slice(f"pii_s_{n}", b * BLOCK + 1, i - b * BLOCK + 1))
            return F.struct((end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("hit"))
        return at

    none = F.array().cast("array<struct<start:int,end:int,hit:string>>")
    rows = rows.withColumns({f"pii_{n}": F.when(F.col(f"pii_a_{n}").isNotNull(), F.transform(f"pii_h_{n}", span(n))).otherwise(none) for n in names})
    return rows.drop(*[f"pii_{x}_{n}" for x in "hsba" for n in names])


def _digits(s):
    return F.regexp_replace(s, r"[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a right check digit."""
    def part(i):
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(F.transform(F.sequence(F.lit(0), F.length(digits) - 1), part), F.lit(0), lambda s, x: s + x) % 10 == 0


def _plain(part):
    return F.regexp_replace(part, r"^0+(?=[0-9])", "")


CHECKS = {
    "email": lambda s: F.lit(True),
    "ip": lambda s: F.forall(F.split(s, r"\."), lambda p: (F.length(_plain(p)) <= 3) & (F.substring(_plain(p), 1, 3).cast("int") <= 255)),
    "card": lambda s: (F.length(_digits(s)) >= 12) & (F.length(_digits(s)) <= 19) & luhn(_digits(s)),
    "phone": lambda s: (F.length(_digits(s)) >= 9) & (F.length(_digits(s)) <= 15),
}


def base_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``pii_text`` and, per kind, ``pii_<kind>``: checked spans in order."""
    docs = docs.withColumn("pii_text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    docs = located(docs, F.col("pii_text"), {k: (PATTERNS[k], MAY_HOLD[k]) for k in KINDS})
    passes = lambda k: lambda x: CHECKS[k](x["hit"])
    return docs.withColumns({f"pii_{k}": F.filter(f"pii_{k}", passes(k)) for k in KINDS})


def _count(s, cls):
    return (F.length(s) - F.length(F.regexp_replace(s, cls, ""))).cast("double")


def features(gen: str, hit, left, right):
    """Feature values of one candidate, in the order of ``FEATURES``."""
    n = F.length(hit).cast("double")
    cue = [F.lower(left).rlike(CUES[c]).cast("double") for c in ("secret", "phone", "card", "mail")]
    return F.array(
        *[F.lit(float(gen == g)) for g in GENERATORS], F.ln(n), _count(hit, "[0-9]"), _count(hit, "[0-9]") / n, _count(hit, "[A-Z]") / n,
        _count(hit, "[a-z]") / n, _count(hit, r"\s"), _count(hit, r"\."), _count(hit, "-"), _count(hit, "@"), hit.startswith("+").cast("double"),
        F.size(F.array_distinct(F.split(hit, "(?!^)"))) / n, hit.rlike("^[0-9a-f]+$").cast("double"), (hit.rlike("[0-9]") & hit.rlike("[A-Za-z]")).cast("double"),
        *cue, left.rlike("[\"'`]$").cast("double"), left.rlike("[=:]\\s*[\"']?$").cast("double"), left.rlike(r"\w$").cast("double"),
        right.rlike("^[\"'`]").cast("double"), right.rlike(r"^\w").cast("double"))


def candidates(docs: DataFrame) -> DataFrame:
    """Adds ``pii_cands``: candidate spans with their features and whether a base span meets them."""
    t = F.col("pii_text")
    docs = located(docs, t, {g: (GENERATORS[g], GEN_MAY[g]) for g in GENERATORS})
    base = F.concat(*[F.col(f"pii_{k}") for k in KINDS])
    docs = docs.withColumn("pii_base", F.transform(base, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))))

    def made(g):
        def one(x):
            left = F.substring(t, F.greatest(x["start"] - CONTEXT, F.lit(0)) + 1, F.least(x["start"], F.lit(CONTEXT)))
            right = F.substring(t, x["end"] + 1, F.lit(2))
            meets = F.exists("pii_base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
            fits = F.exists("pii_base", lambda b: (b["start"] >= x["start"]) & (b["end"] <= x["end"]) & (10 * (b["end"] - b["start"]) >= 8 * (x["end"] - x["start"])))
            named = (F.lower(left).rlike(CUES["secret"] + r"\W{0,6}$") & x["hit"].rlike("[0-9]") & x["hit"].rlike("[A-Za-z]")) if g == "secret" else F.lit(False)
            return F.struct(F.lit(g).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), features(g, x["hit"], left, right).alias("x"),
                            meets.alias("meets"), (fits | named).alias("y"))
        return F.transform(f"pii_{g}", one)

    return docs.withColumn("pii_cands", F.concat(*[made(g) for g in GENERATORS])).drop("pii_base", *[f"pii_{g}" for g in GENERATORS])


class Judge:
    """Trees (nested tuples), their weights and the logistic calibration of the margin."""

    def __init__(self, trees, slope, shift):
        self.trees, self.slope, self.shift = trees, slope, shift

    def margin(self, x) -> Column:
        def walk(node):
            if not isinstance(node, tuple):
                return F.lit(float(node))
            at, cut, left, right = node
            return F.when(F.get(x, F.lit(at)) <= F.lit(float(cut)), walk(left)).otherwise(walk(right))
        out = F.lit(0.0)
        for weight, root in self.trees:
            out = out + F.lit(float(weight)) * walk(root)
        return out

    def probability(self, x) -> Column:
        return 1 / (1 + F.exp(-(self.margin(x) * F.lit(self.slope) + F.lit(self.shift))))


def _tree(node):
    if node.getClass().getSimpleName() == "LeafNode":
        return node.prediction()
    s = node.split()
    return (s.featureIndex(), s.threshold(), _tree(node.leftChild()), _tree(node.rightChild()))


def train_judge(docs: DataFrame, text_col: str = "text") -> Judge | None:
    """Boosted trees and calibration from a bounded sample; None if a class is (nearly) missing."""
    from pyspark.ml.classification import GBTClassifier, LogisticRegression
    from pyspark.ml.functions import array_to_vector

    n = docs.count()
    pick = F.pmod(F.xxhash64(text_col, F.lit(29)), F.lit(1 << 30)) < F.lit(int(min(1.0, SAMPLE_DOCS / max(1, n)) * (1 << 30)))
    picked = docs.select(text_col, F.xxhash64(text_col).alias("h")).where(pick)
    picked = picked.groupBy("h").agg(F.first(text_col).alias(text_col))  # a text of many copies counts once
    some = candidates(base_spans(picked, text_col)).select("pii_cands", "h")
    # written before it is exploded: the filter that explode infers would inline all of the above
    some = written(some, "candidates").select(F.explode("pii_cands").alias("c"), "h")
    some = some.select(F.col("c.x").alias("x"), F.col("c.y").cast("double").alias("label"), F.xxhash64("h", "c.start", "c.kind").alias("h"))
    some = written(some.orderBy("h", "x").limit(SAMPLE_CANDIDATES).coalesce(1).sortWithinPartitions("h", "x"), "training")
    some = some.select(array_to_vector("x").alias("features"), "x", "label", (F.pmod("h", F.lit(4)) == 3).alias("back"))
    sizes = {(r.back, r.label): r["count"] for r in some.groupBy("back", "label").count().collect()}
    if min([sizes.get((b, y), 0) for b in (False, True) for y in (0.0, 1.0)]) < 5:
        return None
    model = GBTClassifier(maxIter=12, maxDepth=3, stepSize=0.25, minInstancesPerNode=5, seed=3).fit(some.where("NOT back"))
    judge = Judge([(w, _tree(t._call_java("rootNode"))) for w, t in zip(model.treeWeights, model.trees)], 2.0, 0.0)
    back = some.where("back").select(array_to_vector(F.array(judge.margin(F.col("x")))).alias("features"), "label")
    fit = LogisticRegression(regParam=1e-3, maxIter=50).fit(back)
    slope, shift = float(fit.coefficients[0]), float(fit.intercept)
    return Judge(judge.trees, slope, shift) if math.isfinite(slope) and math.isfinite(shift) else judge


SPANS = "array<struct<start:int,no:int,end:int,kind:string>>"


def find_private(docs: DataFrame, text_col: str = "text", judge: Judge | None = None, train: bool = True) -> DataFrame:
    """``docs`` with ``pii_base`` and ``pii_spans`` (base and selected spans), sorted by start, then
    kind; and the checked spans per kind (``pii_email``, ...)."""
    added = ["pii_text", *[f"pii_{k}" for k in KINDS], "pii_base", "pii_spans"]
    docs, kept = set_aside(docs, tuple(added))
    text_col = kept[text_col]
    if judge is None and train:
        judge = train_judge(docs, text_col)
    rows = base_spans(docs, text_col)
    named = lambda i, k: lambda x: F.struct(x["start"].alias("start"), F.lit(i).alias("no"), x["end"].alias("end"), F.lit(k).alias("kind"))
    mine = [F.transform(f"pii_{k}", named(i, k)) for i, k in enumerate(KINDS)]
    more = F.array().cast(SPANS)
    if judge is not None:
        rows = candidates(rows)
        number = F.create_map(*[F.lit(v) for i, g in enumerate(GENERATORS) for v in (g, len(KINDS) + i)])
        good = F.filter("pii_cands", lambda c: ~c["meets"] & (judge.probability(c["x"]) >= THRESHOLD))
        more = F.transform(good, lambda c: F.struct(c["start"].alias("start"), F.element_at(number, c["kind"]).alias("no"), c["end"].alias("end"), c["kind"].alias("kind")))
    rows = rows.withColumn("pii_base", F.array_sort(F.concat(*mine).cast(SPANS))).withColumn("pii_more", more.cast(SPANS))
    rows = rows.withColumn("pii_spans", F.array_sort(F.concat("pii_base", "pii_more")))
    return rows.select(*[F.col(v).alias(k) for k, v in kept.items()], *added)


def span_text(spans) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by ``<KIND>``; overlapping spans become one, named after the first."""
    start = F.struct(F.array().cast(SPANS).alias("done"))
    merged = F.aggregate(spans, start, lambda a, x: F.struct(F.when(
        (F.size(a["done"]) > 0) & (F.element_at(a["done"], -1)["end"] > x["start"]),
        F.concat(F.slice(a["done"], F.lit(1), F.size(a["done"]) - 1), F.array(F.struct(
            F.element_at(a["done"], -1)["start"].alias("start"), F.element_at(a["done"], -1)["no"].alias("no"),
            F.greatest(F.element_at(a["done"], -1)["end"], x["end"]).alias("end"), F.element_at(a["done"], -1)["kind"].alias("kind"))))
    ).otherwise(F.concat(a["done"], F.array(x))).alias("done")), lambda a: a["done"])
    return F.when(F.size(spans) == 0, text).otherwise(F.transform(F.array(merged), lambda m: F.concat(
        F.array_join(F.transform(m, lambda x, i: F.concat(
            F.substring(text, F.when(i == 0, F.lit(1)).otherwise(F.get(m, F.greatest(i - 1, F.lit(0)))["end"] + 1),
                        x["start"] - F.when(i == 0, F.lit(0)).otherwise(F.get(m, F.greatest(i - 1, F.lit(0)))["end"])),
            F.lit("<"), F.upper(x["kind"]), F.lit(">"))), ""),
        F.substring(text, F.element_at(m, -1)["end"] + 1, F.length(text))))[0])
