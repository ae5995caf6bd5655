"""Language identification by compression with per-language dictionaries.

Each language's dictionary is raw text of that language.  A text is encoded
block by block with every dictionary, and the language whose dictionary gives
the fewest bytes is chosen.  ``margin`` is how much more, relatively, the
second-best takes; a prediction with a margin under ``MIN_MARGIN`` is not
``accepted``.

Learning: dictionaries are fitted on a bounded sample of the labelled rows, in
which every row has the same chance, drawn by a hash of its id:
``SAMPLE_DOCS`` rows expected per language, a piece of ``PIECE`` characters of
each (at a place drawn by the hash, too), ``DICT_BYTES`` of text per language
in all; with very many languages the dictionaries shrink so that all of them
stay within ``ALL_BYTES``, which is what is broadcast.  Predictions read every
text whole, in blocks.

Before encoding, texts are lower-cased and everything but letters becomes one
space, so that shouting, digits and symbols do not matter.

Defined results: a null text, or one without a letter, is ``und`` with score
0; so is every text if nothing was learned; of equal sizes the language with
more rows to learn from is chosen, then the smaller name; rows with a null lang or id are not learned from, but
are predicted; repeated rows get equal results; other columns are not read.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.sizing import broadcast_limit, fits, measure
from .common import stored

UND = "und"
SAMPLE_DOCS = 400
PIECE = 400
DICT_BYTES = 1 << 16
ALL_BYTES = 1 << 26
BLOCK = 4096            # characters encoded at once
#: Encoder: thorough enough to find the short matches that tell languages apart.
ENCODER = dict(window_log=18, chain_log=16, hash_log=16, search_log=5, min_match=4,
               target_length=32, strategy=zstandard.STRATEGY_GREEDY)
MIN_MARGIN = 0.02
SHARPNESS = 0.5         # bits of size that count as a bit of evidence

_OTHER = re.compile(r"[\W\d_]+")
# numerals other than decimal digits (fractions, superscripts) are word characters, but no letters
_NUMERALS = {c for c in map(chr, range(0x110000)) if c.isalnum() and not c.isalpha() and not c.isdecimal()}


def letters(text: str) -> str:
    """Lower-case letters of a text, a space for everything between."""
    out = _OTHER.sub(" ", text.lower())
    if not out.isascii() and not _NUMERALS.isdisjoint(out):
        out = _OTHER.sub(" ", "".join(" " if c in _NUMERALS else c for c in out))
    return out.strip()


def is_held_out(doc_id: Column) -> Column:
    """Fold of a row; rows of a null id are in none and not learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame) -> dict[str, bytes]:
    """Dictionary of each language, from (doc_id, text, lang) rows; languages
    with more rows come first."""
    d = docs.where("text is not null and lang is not null and doc_id is not null")
    draw = F.xxhash64(F.lit("langid"), "doc_id")
    chance = F.shiftrightunsigned(draw, 11) / F.lit(float(1 << 53))
    n = d.groupBy(F.col("lang").alias("l")).agg(F.count(F.lit(1)).alias("n"))
    n = stored(n, "languages")
    # a row per language; texts are not shuffled to meet it
    n = F.broadcast(n) if fits(*measure(n), broadcast_limit(d.sparkSession)) else n
    d = d.join(n, F.col("lang") == F.col("l"))
    d = d.where(chance * F.col("n") < SAMPLE_DOCS)
    start = F.pmod(draw, F.greatest(F.char_length("text") - PIECE, F.lit(1))).cast("int") + 1
    rows = d.select("lang", "n", draw.alias("draw"), F.substring("text", start, F.lit(PIECE)).alias("piece")).collect()
    texts: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (-r.n, r.lang, r.draw, r.piece)):
        texts.setdefault(r.lang, []).append(letters(r.piece))
    most = min(DICT_BYTES, ALL_BYTES // max(1, len(texts)))
    found = {k: " ".join(v).encode()[:most] for k, v in texts.items()}
    return {k: v for k, v in found.items() if len(v) >= 8}   # the least that zstd takes


class Coder:
    """The learned dictionaries, ready to encode with."""

    def __init__(self, dicts: dict[str, bytes]):
        self.langs = list(dicts)
        self.coders = []
        how = zstandard.ZstdCompressionParameters(write_content_size=0, write_checksum=0,
                                                  write_dict_id=0, **ENCODER)
        for k in self.langs:
            d = zstandard.ZstdCompressionDict(dicts[k], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=how)
            self.coders.append(zstandard.ZstdCompressor(compression_params=how, dict_data=d))

    def predict(self, text: str | None) -> tuple[str, float, float | None]:
        """(language, score, margin) of a text."""
        seen = False
        sizes = [0] * len(self.langs)
        for at in range(0, len(text or ""), BLOCK):
            block = letters(text[at:at + BLOCK])
            if not block:
                continue
            seen, data = True, block.encode()
            for i, c in enumerate(self.coders):
                sizes[i] += len(c.compress(data))
        if not seen or not self.langs:
            return UND, 0.0, None
        best = min(range(len(sizes)), key=lambda i: (sizes[i], i))
        score = 1 / sum(math.exp(-math.log(2) * 8 * SHARPNESS * min(s - sizes[best], 64)) for s in sizes)
        others = [s for i, s in enumerate(sizes) if i != best]
        margin = (min(others) - sizes[best]) / sizes[best] if others else 1.0
        return self.langs[best], score, margin


def predict(docs: DataFrame, dicts: dict[str, bytes], keys: list[str],
            text: str = "text") -> DataFrame:
    """``keys`` with lang_pred, score, margin and accepted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(dicts)

    def run(batches):
        coder = Coder(shared.value)
        for b in batches:
            got = [coder.predict(t.as_py()) for t in b.column(len(keys))]
            pred, score, margin = zip(*got) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(len(keys))), pa.array(pred, pa.string()),
                 pa.array(score, pa.float64()), pa.array(margin, pa.float64())],
                [*keys, "lang_pred", "score", "margin"])

    d = docs.select(*keys, F.col(text))
    schema = d.select(*keys).schema.add("lang_pred", "string").add("score", "double").add(
        "margin", "double")
    return d.mapInArrow(run, schema).withColumn(
        "accepted", F.coalesce(F.col("margin") >= MIN_MARGIN, F.lit(False)))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, margin, accepted of every document;
    learned from those that are not held out."""
    d = docs.select("doc_id", "text", "lang")
    dicts = learn(d.where(~is_held_out(F.col("doc_id"))))
    p = predict(d, dicts, ["doc_id"])
    return p.withColumn("held_out", is_held_out(F.col("doc_id"))).select(
        "doc_id", "held_out", "lang_pred", "score", "margin", "accepted")
