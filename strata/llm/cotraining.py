"""Quality classifier by co-training.

Two views of a document are taken to be independent given its class: its text
(shapes of its words, whether a word repeats the one before, and its words,
hashed) and its metadata (source, language, and the sizes on its page: length,
lines, length of lines).  Each view has a naive Bayes classifier
(one pass over the training rows), calibrated (Platt) on labelled documents
that neither view learns from.  Over ``ROUNDS`` rounds both are trained, score
every document that they have no label of, and each hands the other all the
labels that it is confident of.  Handed-over labels are weighted so that each class keeps
its share among the labelled documents and all of them together count as much as
those, however many there are.  A naive Bayes classifier reads only the weighted
sum of its rows by class, so what a class is handed goes in as its mean row with
the class's whole weight: a round is one pass over the stored views, which scores
both and adds up, within tasks and then in ``SPREAD`` parts, what they hand over.
In the end the calibrated views are combined as
independent evidence, the log-odds of both less the prior's, to score every
document whole.

About ``LABELLED`` labelled documents are learned from, drawn by a hash of the id
with equal chances; the drawn ids (bounded by that) are broadcast.  Every other
document is unlabelled, its label, if it has one, is not read.  Nothing else is
bounded.  The views of all documents are computed and stored once; neither texts
nor views are shuffled, but for those of the drawn documents.

Defined results: a null text is scored like an empty one, null metadata are
values of their own; a document with labels that disagree takes the majority, a
tie counts as good; without labels of both classes every score is the share of
good labels (0.5 without any); rows without an id are scored, not learned
from; repeated rows get equal scores; an empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, NaiveBayes, NaiveBayesModel
from pyspark.ml.feature import HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import GAP, stored

LABELLED = 20_000     # expected number of labelled documents learned from
ROUNDS = 3
SURE = 0.95           # confidence at which a label is handed over
HELD = 5              # one in so many labelled documents is for calibration
TEXT_SIZE, META_SIZE = 1 << 14, 1 << 10
PARTS = 8             # files of the labelled sample, whatever the session's shuffles
SPREAD = 64           # parts in which the tasks' means of a view and class are combined first
OTHER = {"text_view": "meta_view", "meta_view": "text_view"}
KEEP = 0.5


def _tokens_of_text(text: Column) -> Column:
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(
        text, r"\p{Ll}+", "a"), r"\p{Lu}+", "A"), r"\p{Nd}+", "0")
    return F.transform(F.split(shape, GAP), lambda s: F.concat(F.lit("shape "), F.substring(s, 1, 12)))


def _size_class(name: str, n: Column) -> Column:
    return F.concat(F.lit(f"{name} "), F.floor(F.log2(F.greatest(n, F.lit(0)) + 1)).cast("string"))


def views(docs: DataFrame) -> DataFrame:
    """``doc_id`` with the vectors ``text_view`` and ``meta_view``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", "lang", "source", text.alias("text"))
    d = d.withColumn("words", F.split(F.lower("text"), GAP))
    w = F.col("words")
    again = F.transform(w, lambda x, i: F.when(
        (i > 0) & (x == w[F.greatest(i - 1, F.lit(0))]), F.lit("again")).otherwise(F.lit("new")))
    lines = F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    chars = F.char_length("text")
    meta = F.array(
        F.concat(F.lit("source "), F.coalesce("source", F.lit("\0"))),
        F.concat(F.lit("lang "), F.coalesce("lang", F.lit("\0"))),
        F.concat(F.lit("both "), F.coalesce("source", F.lit("\0")), F.lit("\0"), F.coalesce("lang", F.lit("\0"))),
        _size_class("chars", chars), _size_class("lines", lines),
        _size_class("line", F.floor(chars / lines)), F.lit("any"))
    d = d.select("doc_id", _tokens_of_text(F.col("text")).alias("shapes"), again.alias("again"), "words",
                 meta.alias("meta"))
    for tokens, size, out in (("shapes", 1 << 10, "shapes_v"), ("again", 1 << 4, "again_v"),
                              ("words", TEXT_SIZE, "words_v"), ("meta", META_SIZE, "meta_view")):
        tf = f"{out}_tf" if out != "meta_view" else out
        d = HashingTF(inputCol=tokens, outputCol=tf, numFeatures=size).transform(d).drop(tokens)
        if tf != out:     # each group of tokens counts alike, whatever the text's length
            d = Normalizer(p=2.0, inputCol=tf, outputCol=out).transform(d).drop(tf)
    d = VectorAssembler(inputCols=["shapes_v", "again_v", "words_v"], outputCol="text_view").transform(d)
    return d.select("doc_id", "text_view", "meta_view")


def _chance(salt: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(salt), "doc_id"), 11) / F.lit(float(1 << 53))


def _fit(rows: DataFrame, view: str) -> NaiveBayesModel:
    return NaiveBayes(featuresCol=view, labelCol="label", weightCol="weight", smoothing=0.1, probabilityCol="p",
                      rawPredictionCol="raw", predictionCol="said").fit(rows)


def _z(model: NaiveBayesModel, rows: DataFrame, out: str) -> DataFrame:
    """Adds the log-odds that a view's model gives."""
    raw = vector_to_array("raw")
    return model.transform(rows).withColumn(out, raw[1] - raw[0]).drop("p", "raw", "said")


def _platt(z: DataFrame) -> tuple[float, float]:
    """Slope and intercept that turn the log-odds ``z`` into calibrated ones."""
    x = VectorAssembler(inputCols=["z"], outputCol="x").transform(z)
    m = LogisticRegression(featuresCol="x", labelCol="label", regParam=1e-3, maxIter=20).fit(x)
    return float(m.coefficients[0]), float(m.intercept)


def _logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
    return F.log(q / (1 - q))


def _calibrated(view: tuple, rows: DataFrame, out: str) -> DataFrame:
    """Adds the calibrated probability of a good document by one view."""
    model, a, b = view
    return _z(model, rows, "z").withColumn(out, 1 / (1 + F.exp(-(a * F.col("z") + b)))).drop("z")


def _drawn(labels: DataFrame) -> DataFrame:
    """Stored (doc_id, label) of the labelled documents to learn from."""
    named = stored(labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
                   .agg((F.avg("quality") >= 0.5).cast("double").alias("label")), "labels")
    return stored(named.where(_chance("labelled") < LABELLED / max(named.count(), 1)).coalesce(PARTS), "drawn")


def _samples(seen: DataFrame, drawn: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``views``: the drawn documents' with their label, one of an id; and
    all other documents'."""
    few = seen.join(F.broadcast(drawn), "doc_id").dropDuplicates(["doc_id"])
    pool = seen.where("doc_id is not null").join(F.broadcast(drawn), "doc_id", "left_anti")
    return few, pool


def _handed(models: dict[str, tuple], pool: DataFrame, sure: float) -> DataFrame:
    """Stored (view, label, n, mean) of what each view is handed by the other:
    how many rows of ``pool`` the other is confident of by class, and the mean of
    the view's vectors of these."""
    rows = pool.select(*OTHER)
    for v in OTHER:
        rows = _calibrated(models[v], rows, f"p_{v}")
    given = []
    for v, teacher in OTHER.items():
        p = F.col(f"p_{teacher}")
        label = F.when(p >= sure, F.lit(1.0)).when(p <= 1 - sure, F.lit(0.0))
        given.append(F.struct(F.lit(v).alias("view"), label.alias("label"), F.col(v).alias("x")))
    rows = rows.select(F.pmod(F.spark_partition_id(), F.lit(SPREAD)).alias("part"),
                       F.explode(F.filter(F.array(*given), lambda g: g["label"].isNotNull())).alias("g"))
    parts = rows.select("part", "g.*").groupBy("part", "view", "label").agg(
        F.count(F.lit(1)).alias("n"), Summarizer.mean(F.col("x")).alias("x"))
    return stored(parts.groupBy("view", "label").agg(
        F.sum("n").alias("n"), Summarizer.mean(F.col("x"), F.col("n").cast("double")).alias("mean")), "handed")


def _weights(counts: dict[float, int], train: dict[float, int]) -> dict[float, float]:
    """Weight of a handed-over label by class: the classes keep their shares among
    the training rows, and all labels together weigh as much as those rows."""
    return {c: train[c] / n for c, n in counts.items() if n}


def _counts(rows: DataFrame) -> dict[float, int]:
    return {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}


class QualityModel:
    """Trained views, their calibration and the prior.  ``seen`` holds the views of
    all documents; ``handed`` how many labels of each class each view was given,
    round by round."""

    def __init__(self, docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, sure: float = SURE):
        self.seen = stored(views(docs), "views")
        few, pool = _samples(self.seen, _drawn(labels))
        rows = stored(few.repartition(PARTS), "labelled")
        good, n = rows.agg(F.sum("label"), F.count(F.lit(1))).first()
        self.prior = (good or 0) / n if n else 0.5
        self.views, self.handed = {}, []
        held = F.pmod(F.xxhash64(F.lit("held"), "doc_id"), F.lit(HELD)) == 0
        train, calibrate = rows.where(~held), rows.where(held)
        classes = _counts(train)
        if len(classes) < 2 or len(_counts(calibrate)) < 2:
            return
        models = {}
        for k in range(rounds + 1):
            new = _handed(models, pool, sure) if models else None
            taught, given = {}, {}
            for v in OTHER:
                use = train.select(v, "label", F.lit(1.0).alias("weight"))
                if models:      # each view teaches the other
                    mine = new.where(F.col("view") == v)
                    given[v] = {r["label"]: r["n"] for r in mine.select("label", "n").collect()}
                    w = F.lit(0.0)
                    for c, x in _weights(given[v], classes).items():
                        w = F.when(F.col("label") == c, F.lit(x) * F.col("n")).otherwise(w)
                    use = use.unionByName(mine.select(F.col("mean").alias(v), "label", w.alias("weight")))
                model = _fit(use, v)
                a, b = _platt(_z(model, calibrate.select(v, "label"), "z").select("z", "label"))
                taught[v] = model, a, b
            models = taught
            if given:
                self.handed.append(given)
        self.views = models

    def score(self, docs: DataFrame | None = None) -> DataFrame:
        """(doc_id, p_text, p_meta, score) of every row; by default of those that
        the model was made with, whose views are stored."""
        d = self.seen if docs is None else views(docs)
        if not self.views:
            p = F.lit(float(self.prior))
            return d.select("doc_id", p.alias("p_text"), p.alias("p_meta"), p.alias("score"))
        logits = []
        for v, out in (("text_view", "p_text"), ("meta_view", "p_meta")):
            d = _calibrated(self.views[v], d, out).drop(v)
            logits.append(_logit(F.col(out)))
        z = logits[0] + logits[1] - _logit(F.lit(float(self.prior)))
        return d.select("doc_id", "p_text", "p_meta", (1 / (1 + F.exp(-z))).alias("score"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, p_text, p_meta, score and kept of every document."""
    model = QualityModel(docs.select("doc_id", "text", "lang", "source"), labels)
    return model.score().withColumn("kept", F.col("score") >= KEEP)
