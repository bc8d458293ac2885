r"""Personal data by candidate generation and gradient boosting (JVM expressions and pyspark.ml only).

Generators with high recall propose overlapping spans: e-mail addresses, dotted numbers, digit
groups, plus numbers, long digit or punctuated number runs, and long letter-digit runs. Spans that pass
the fixed checks (number ranges, Luhn, digit counts) are base spans and always stay. Boosted trees
score the other spans by format and context; candidates on base spans and key = "value" secrets are the
positive cases, on features that leave the deciding check itself out. The trees are fitted on a bounded
sample of different candidates, drawn by kind and label. Every candidate of the corpus (those few
included) calibrates its kind: the threshold is the smallest score whose precision over all of them
reaches ``precision``. The fitted trees become one SQL expression, so scoring runs in the scan.

Defined results: a null text is empty; without both classes in the sample nothing is added;
repeated rows are judged one by one; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ragloom.llm.common import let, materialize

#: Base kinds in their fixed order, with the patterns. Possessive forms match the same spans: a run that
#: fails from its start fails from any later start. \G: a span may begin where the last one ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9]++(?:[ -][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE_KINDS = ("email", "ip", "card", "phone")
#: Kinds that the method adds.
NUMBER = r"(?<![A-Za-z0-9])[(]?[0-9][0-9().\x20-]{6,28}[0-9](?![A-Za-z0-9])"
SECRET = r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{20,}+"  # whole runs, of any length
KINDS = (*BASE_KINDS, "number", "secret")
SECRET_KEY = r"(?i)(token|secret|password|passwd|api_?key)[\x20]?[=:][\x20]?[\"']?$"
CONTEXT_WORDS = r"(?i)(phone|tel|call|mobile|fax|card|visa|account|token|secret|password|key|id|contact|mail)"
SPAN = "struct<kind:int,a:int,b:int,text:string,before:string,after:string>"


@dataclass(frozen=True)
class PiiParams:
    sample_candidates: int = 4000  # bound of the sample that fits the trees
    trees: int = 8
    depth: int = 3
    precision: float = 0.9
    least_positives: int = 20      # calibration cases a kind needs before anything is added


def _matches(text: Column, pattern: str, kind: int) -> Column:
    """All leftmost non-overlapping matches as SPAN structs: the pieces between matches give the places."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    n = F.size(found)

    def add(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["m"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("a"), end.alias("b"), x["m"].alias("text"),
                        F.right(x["gap"], F.lit(24)).alias("before"), F.left(x["next"], F.lit(8)).alias("after"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    zipped = let(F.struct(found.alias("f"), gaps.alias("g")), lambda z: F.arrays_zip(
        z["f"].alias("m"), F.slice(z["g"], F.lit(1), F.size(z["f"])).alias("gap"), F.slice(z["g"], F.lit(2), F.size(z["f"])).alias("next")))
    none = F.array().cast(f"array<{SPAN}>")
    return F.when(n > 0, F.aggregate(zipped, F.struct(F.lit(0).alias("at"), none.alias("out")), add, lambda acc: acc["out"])).otherwise(none)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Luhn check of a string of digits."""
    doubled = F.transform(F.sequence(F.lit(1), F.length(number)), lambda i: let(
        F.substring(number, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1), lambda d: F.when(d > 9, d - 9).otherwise(d)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def passes(span: Column) -> Column:
    """The fixed check of a base kind; false for the others."""
    text, kind = span["text"], span["kind"]
    # parts of 4 and more digits are compared by length without their zeros: no overflow
    ip = F.forall(F.split(text, r"\."), lambda x: let(F.regexp_replace(x, "^0+(?=.)", ""), lambda y: (F.length(y) <= 3) & (y.try_cast("int") <= 255)))
    n = F.length(digits(text))
    return (F.when(kind == 0, F.lit(True)).when(kind == 1, ip)
            .when(kind == 2, F.when(n.between(14, 19), luhn(digits(text))).otherwise(False))
            .when(kind == 3, n.between(10, 15)).otherwise(False))


def candidates(docs: DataFrame) -> DataFrame:
    """The rows with a column ``spans``: all candidates with ``base``, true for those that pass their check."""
    t = F.col("text")
    digit = t.rlike("[0-9]")
    none = F.array().cast(f"array<{SPAN}>")
    gate = {0: F.contains(t, F.lit("@")), 1: digit, 2: digit, 3: F.contains(t, F.lit("+")), 4: digit, 5: digit}
    kinds = [F.when(gate[k], _matches(t, pattern, k)).otherwise(none) for k, pattern in enumerate((EMAIL, IP, CARD, PHONE, NUMBER, SECRET))]
    # single digits and short groups are no candidates of a card; nothing else is left out
    some = F.filter(F.concat(*kinds), lambda s: (s["kind"] != 2) | (F.length(s["text"]) >= 7))
    return docs.withColumn("spans", F.transform(some, lambda s: F.struct(
        s["kind"].alias("kind"), s["a"].alias("a"), s["b"].alias("b"), s["text"].alias("text"), s["before"].alias("before"),
        s["after"].alias("after"), passes(s).alias("base"))))


FEATURES = ("length", "n_digits", "n_groups", "longest_gap", "n_space", "n_dash", "n_dot", "paren", "plus", "n_alpha", "hex",
            "context", "quoted", "assigned", "punct_after")


def features(s: Column) -> list[Column]:
    """Format and context of a span, as doubles in the order of FEATURES."""
    text, before = s["text"], s["before"]
    n = F.length(text)
    count = lambda chars: (n - F.length(F.regexp_replace(text, chars, ""))).cast("double")
    flag = lambda c: c.cast("int").cast("double")
    return [n.cast("double"), count("[0-9]"), F.size(F.split(text, "[^0-9]+")).cast("double"),
            F.array_max(F.transform(F.split(text, "[0-9]+"), lambda x: F.length(x))).cast("double"),
            count(r"[\x20]"), count("-"), count(r"\."), flag(text.rlike("[()]")), flag(text.rlike(r"^\+") | before.rlike(r"\+[0-9\x20]{0,4}$")),
            count("[A-Za-z]"), flag(text.rlike("^[0-9a-f]+$")), flag(before.rlike(CONTEXT_WORDS)), flag(before.rlike("[\"']$")),
            flag(before.rlike(r"[=:][\x20]?[\"']?$")), flag(s["after"].rlike(r"^[.,;!?]"))]


def _seen_by(spans: Column):
    """``hit``: the candidate is a base span or overlaps one."""
    return lambda s: F.struct(s.alias("s"), (s["base"] | F.exists(
        spans, lambda y: y["base"] & (y["a"] < s["b"]) & (s["a"] < y["b"]))).alias("hit"))


def labelled(docs: DataFrame) -> DataFrame:
    """All candidates, written once: kind, features, label, draw (the same for candidates of equal text and place)."""
    one = candidates(docs.select(F.coalesce("text", F.lit("")).alias("text"))).filter(F.size("spans") > 0).select(
        F.explode(F.transform("spans", _seen_by(F.col("spans")))).alias("x")).select("x.*")
    positive = F.col("hit") | ((F.col("s.kind") == 5) & F.col("s.before").rlike(SECRET_KEY))
    return materialize(one.select(
        F.col("s.kind").alias("kind"), *[c.alias(f) for c, f in zip(features(F.col("s")), FEATURES)], positive.cast("double").alias("label"),
        F.xxhash64("s.text", "s.before", "s.a").alias("draw")))


def fitting_sample(rows: DataFrame, p: PiiParams) -> DataFrame:
    """At most ``sample_candidates`` different candidates, as many of each kind and label: features, label, kind."""
    key, quota = ["kind", "label", "draw"], p.sample_candidates // (2 * len(KINDS))
    # a rank limit below 1000 is applied in each task before the exchange by kind and label
    nth = F.row_number().over(Window.partitionBy("kind", "label").orderBy("draw"))
    drawn = rows.select(key).distinct().withColumn("nth", nth).filter(F.col("nth") <= quota).drop("nth")
    one = rows.join(F.broadcast(drawn), key).groupBy(key).agg(F.min(F.struct(*FEATURES)).alias("f")).select(*key, "f.*")
    return materialize(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(one)
                       .coalesce(1).sortWithinPartitions(key).select("features", "label", "kind"))


def _tree_sql(node) -> str:
    if node.numDescendants() == 0:
        return repr(float(node.prediction()))
    split = node.split()
    name = FEATURES[split.featureIndex()]
    return f"IF(f.{name} <= {float(split.threshold())!r}D, {_tree_sql(node.leftChild())}, {_tree_sql(node.rightChild())})"


@dataclass(frozen=True)
class PiiModel:
    """``margin``: SQL over a struct f of the features; ``thresholds``: least margin by added kind."""

    margin: str
    thresholds: dict[int, float]


#: Margins are counted in steps of 1 / LEVELS (exact in binary): the histogram's size depends on the trees alone.
LEVELS = 4096


def calibrate(rows: DataFrame, margin: str, p: PiiParams) -> dict[int, float]:
    """Least margin by added kind, over all its candidates."""
    level = F.floor(F.expr(margin) * LEVELS).alias("level")
    counts = rows.filter(F.col("kind") >= len(BASE_KINDS)).select("kind", "label", F.struct(*FEATURES).alias("f")).select(
        "kind", "label", level).groupBy("kind", "level").agg(F.sum("label").alias("good"), F.count("*").alias("seen")).collect()
    thresholds = {}
    for kind in range(len(BASE_KINDS), len(KINDS)):
        good = seen = 0
        for r in sorted((r for r in counts if r["kind"] == kind), key=lambda r: -r["level"]):
            good, seen = good + r["good"], seen + r["seen"]
            if good >= p.least_positives and good / seen >= p.precision:
                thresholds[kind] = r["level"] / LEVELS
    return thresholds


def fit(docs: DataFrame, p: PiiParams = PiiParams()) -> PiiModel | None:
    """Boosted trees on the sample, thresholds on all candidates; None without both classes."""
    rows = labelled(docs)
    train = fitting_sample(rows, p)
    if train.select("label").distinct().count() < 2:
        return None
    model = GBTClassifier(maxIter=p.trees, maxDepth=p.depth, seed=7, maxMemoryInMB=64, checkpointInterval=-1).fit(train)
    terms = [f"{float(w)!r}D * {_tree_sql(t._java_obj.rootNode())}" for w, t in zip(model.treeWeights, model.trees)]
    margin = " + ".join(terms)
    return PiiModel(margin, calibrate(rows, margin, p))


def find_spans(docs: DataFrame, model: PiiModel | None) -> DataFrame:
    """The rows with ``spans``: base spans, and candidates of the added kinds that the model selects.

    An added span that overlaps a base span adds nothing to redact and is left out."""
    out = candidates(docs)
    spans = F.col("spans")
    if model is None or not model.thresholds:
        return out.withColumn("spans", F.filter(spans, lambda s: s["base"]))
    least = F.create_map(*[F.lit(x) for k, v in model.thresholds.items() for x in (k, v)])
    # trees over struct fields: the margin is SQL over ``f``, one evaluation a candidate
    out = out.withColumn("spans", F.transform(spans, lambda s: F.struct(
        s.alias("s"), F.struct(*[c.alias(n) for c, n in zip(features(s), FEATURES)]).alias("f"))))
    scored = f"transform(spans, x -> struct(x.s AS s, {model.margin.replace('f.', 'x.f.')} AS m))"
    out = out.withColumn("spans", F.when(F.size("spans") > 0, F.expr(scored)).otherwise(F.expr(scored.replace("transform(spans,", "transform(slice(spans, 1, 0),"))))
    base = lambda z: F.filter(z, lambda x: x["s"]["base"])

    def selected(z):
        own = base(z)
        return F.filter(z, lambda x: x["s"]["base"] | (F.coalesce(x["m"] >= F.element_at(least, x["s"]["kind"]), F.lit(False)) & ~F.exists(
            own, lambda y: (y["s"]["a"] < x["s"]["b"]) & (x["s"]["a"] < y["s"]["b"]))))
    return out.withColumn("spans", F.transform(let(F.col("spans"), selected), lambda x: x["s"]))


def _listed(spans: Column) -> Column:
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["a"].alias("a"), s["kind"].alias("kind"), s["b"].alias("b"))))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(order, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["a"].cast("string"), s["b"].cast("string"))), ",")


def pii_report(docs: DataFrame, p: PiiParams = PiiParams()) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = find_spans(own, fit(own, p)).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["base"])
    return found.select("doc_id", *[F.size(F.filter(base, _of(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(BASE_KINDS)],
                        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def _of(kind: int):
    return lambda s: s["kind"] == kind


def redact(docs: DataFrame, p: PiiParams = PiiParams()) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; overlapping spans become one, of the first kind.

    All columns stay; a text without spans is unchanged; ``n_chars`` follows the text if it is there."""
    model = fit(docs.select("text"), p)
    renamed = docs.withColumnRenamed("spans", "_spans") if "spans" in docs.columns else docs
    found = find_spans(renamed, model)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def step(text):
        def add(acc, s):
            new = s["a"] >= acc["at"]
            return F.struct(F.when(new, F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["a"] - acc["at"]),
                                                 F.element_at(names, s["kind"] + 1))).otherwise(acc["out"]).alias("out"),
                            F.greatest(acc["at"], s["b"]).alias("at"))
        return add

    def rebuild(z):
        order = F.array_sort(F.transform(z["spans"], lambda s: F.struct(s["a"].alias("a"), s["kind"].alias("kind"), s["b"].alias("b"))))
        return F.aggregate(order, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step(z["text"]),
                           lambda acc: F.concat(acc["out"], F.substring(z["text"], acc["at"] + 1, F.length(z["text"]))))
    z = F.struct(F.col("text").alias("text"), F.col("spans").alias("spans"))
    out = found.withColumn("text", F.when(F.size("spans") > 0, let(z, rebuild)).otherwise(F.col("text"))).drop("spans")
    if "spans" in docs.columns:
        out = out.withColumnRenamed("_spans", "spans")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
