"""Surrogates for personal data.

Detected entities are replaced by made-up ones of the same kind: digits by
digits, letters by letters of the same case, separators kept; a card number
keeps its first digit and its check sum, an address its four octets, an e-mail
address its top-level domain, a secret its alphabet, a person's name its
gender, script and case.  A surrogate is a keyed hash of the entity, so the
same entity has the same surrogate in every document, however it is written:
``+1 (555) 555-0100`` and ``+1 555 555 0100`` are one number, ``A@b.example``
and ``a@b.example`` one address.  A name's parts and an address's domain are
entities of their own, so ``Mrs. Ann Lee`` and ``Mrs. Lee`` stay one person and
addresses of one domain stay together.

Distinctness is checked over the whole corpus: no two entities of a kind share
a surrogate and no surrogate is an entity that occurs.  Those that fail the
check are drawn again with the next attempt number (the smallest entity keeps a
contested surrogate), until none is left; where a short format has no free
values left the surrogate grows longer.

Everything is DataFrame functions.  Texts are read once to find entities and
joined once with their replacements.  Entities are combined within each task
before they are shuffled; the join of occurrences with surrogates is between
stored tables, so one entity that fills a third of the corpus is split.

Defined results: null and empty texts stay; rows that agree in id and text are
one record; the whole of every text is read; an empty table gives an empty
result; other columns are carried (one named ``n_replaced`` is replaced).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, row_key, stored, unpacked

DEFAULT_KEY = "set-your-own-key"
STRICT = 6           # attempts before a surrogate may grow longer
MAX_ATTEMPTS = 64

#: Honorifics by the gender they tell.
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Sra", "Srta", "Madame", "Mme", "Mlle",
          "Doña", "госпожа", "г-жа")
MALE = ("Mr", "Herr", "Señor", "Sr", "Monsieur", "Don", "господин", "г-н")
NEUTRAL = ("Dr", "Prof")

_TITLE = "(?:" + "|".join(FEMALE + MALE + NEUTRAL) + r")\.?"
_PART = r"\p{Lu}[\p{L}'’-]+"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
#: Kinds in the order in which they are tried at a place.
KINDS = {
    "email": r"(?<![\w.%+-])[\w.%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ip": rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\w]|\.\d)",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?\d{3}[ .-]?\d{3,4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)"
             r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\w)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "card": r"(?<!\w)\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,4}(?!\w)",
    "secret": r"(?<!\w)(?:[0-9a-f]{32,128}|[0-9A-F]{32,128}|AKIA[0-9A-Z]{16}|(?:sk|ghp|xoxb)[-_][A-Za-z0-9_-]{20,})(?!\w)",
    "name": rf"(?<![\p{{L}}]){_TITLE} {_PART}(?: {_PART}){{0,2}}",
}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())

_SYLLABLES = {"latin": "bra cal den fer gil hol jan kel lor mar nev ost pel quin ras sol tam urs vel wes "
                       "xan yor zel dor fin gar hel ker lan mir nor rol",
              "cyrillic": "бра вел гор дан жел зор кал лев мир нов ост пел рад сол там урс фед хол чер шан "
                          "бел вар гал дор зел кир лан мал нор рол сев тор"}
_ENDINGS = {("latin", "f"): "a ia ine elle", ("latin", "m"): "o us ert an", ("latin", "n"): "in ey el is",
            ("cyrillic", "f"): "а ия ина ела", ("cyrillic", "m"): "он ус ер ан",
            ("cyrillic", "n"): "ин ей ель ис"}


def _words(text: str) -> Column:
    return F.array(*[F.lit(w) for w in text.split()])


def kind_of(match: Column) -> Column:
    """Kind of a found entity: the first whose whole pattern it fits."""
    return F.coalesce(*[F.when(F.rlike(match, F.lit(rf"\A(?:{p})\z")), F.lit(k))
                        for k, p in KINDS.items()], F.lit("secret"))


def parts_of(kind: Column, match: Column) -> Column:
    """The parts of a match that are replaced: (kind, original, canonical, said:
    the gender that a title tells)."""
    part = lambda k, o, c, g=F.lit(None).cast("string"): F.struct(
        k.alias("kind"), o.alias("original"), c.alias("canonical"), g.alias("said"))
    local = F.substring_index(match, "@", 1)
    domain = F.regexp_extract(match, r"@(.*)\.[^.]*\z", 1)
    words = F.split(F.regexp_replace(match, rf"\A{_TITLE} ", ""), " ")
    title = F.regexp_extract(match, r"\A([^. ]*)", 1)
    said = F.when(title.isin(*FEMALE), "f").when(title.isin(*MALE), "m").otherwise("n")
    names = F.transform(words, lambda w, i: part(
        F.when(i < F.size(words) - 1, "given").otherwise("family"), w, F.lower(w), said))
    plain = F.when(kind.isin("phone", "ssn", "card"), F.regexp_replace(match, r"\D", "")).when(
        kind == "iban", F.replace(match, F.lit(" "), F.lit(""))).when(
        kind == "secret", F.when(F.rlike(match, F.lit(r"\A[0-9A-F]+\z")), F.lower(match))
        .otherwise(match)).otherwise(match)
    return (F.when(kind == "email", F.array(part(F.lit("email"), local, F.lower(match)),
                                            part(F.lit("domain"), domain, F.lower(domain))))
            .when(kind == "name", names).otherwise(F.array(part(kind, match, plain))))


def _stream(key: str, kind: Column, canonical: Column, attempt: int, n: Column) -> Column:
    """``n`` or more keyed bytes, as an array of numbers."""
    seed = F.concat(F.lit(f"{key}\0{attempt}\0"), kind, F.lit("\0"), canonical, F.lit("\0"))
    hexes = F.array_join(F.transform(F.sequence(F.lit(0), F.floor(n / 32).cast("int")),
                                     lambda b: F.sha2(F.concat(seed, b.cast("string")), 256)), "")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.conv(
        F.substring(hexes, 2 * i + 1, F.lit(2)), 16, 10).cast("int"))


def _chars(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def _one_of(alphabet: str, v: Column) -> Column:
    return F.substring(F.lit(alphabet), (v % len(alphabet)).cast("int") + 1, F.lit(1))


_DIGITS, _HEX, _LOWER = "0123456789", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz"


def _luhn(digits: Column) -> Column:
    """Check sum of an array of digits, the last not doubled."""
    n = F.size(digits)
    each = F.transform(digits, lambda d, i: F.when(
        (n - 1 - i) % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, d: a + d) % 10


def draw(e: DataFrame, key: str, attempt: int) -> DataFrame:
    """Adds ``surrogate`` to entities (kind, canonical, gender)."""
    kind, canonical = F.col("kind"), F.col("canonical")
    longer = max(0, attempt - STRICT)
    base = F.when(kind == "email", F.substring_index(canonical, "@", 1)).otherwise(canonical)
    chars = _chars(base)
    e = e.withColumn("chars", chars).withColumn(
        "v", _stream(key, kind, canonical, attempt, F.greatest(F.size("chars"), F.lit(8)) + longer))
    v = F.col("v")
    swap = F.transform("chars", lambda c, i: (
        F.when((kind == "secret") & F.rlike(canonical, F.lit(r"\A[0-9a-f]+\z")), _one_of(_HEX, v[i]))
        .when(F.rlike(c, F.lit(r"\A[0-9]\z")), F.when(
            (i == 0) & kind.isin("card", "phone"), c).otherwise(_one_of(_DIGITS, v[i])))
        .when((kind == "iban") & (i < 2), c)
        .when((kind == "secret") & (i < 3), c)
        .when(F.rlike(c, F.lit(r"\A[A-Z]\z")), _one_of(_LOWER.upper(), v[i]))
        .when(F.rlike(c, F.lit(r"\A\p{L}\z")), _one_of(_LOWER, v[i])).otherwise(c)))
    tail = F.array_join(F.transform(F.slice(v, F.size(v) - longer + 1, F.lit(longer)),
                                    lambda x: _one_of(_DIGITS, x)), "") if longer else F.lit("")
    e = e.withColumn("swap", swap)
    digits = F.transform("swap", lambda c: F.expr("0") + c.cast("int"))
    was = F.transform("chars", lambda c: c.cast("int"))
    # the last digit makes up for what the others changed in the check sum
    last = (F.element_at(digits, -1) + _luhn(was) - _luhn(digits) + 10) % 10
    card = F.concat(F.array_join(F.slice("swap", F.lit(1), F.size("swap") - 1), ""), last.cast("string"))
    octets = F.array_join(F.array(*[(v[i] if i else v[0] % 223 + 1).cast("string") for i in range(4)]), ".")
    script = F.rlike(canonical, F.lit("[Ѐ-ӿ]"))
    names = []
    for s, holds in (("cyrillic", script), ("latin", F.lit(True))):
        table = _words(_SYLLABLES[s])
        n = 2 + longer
        stem = F.concat(*[table[v[i] % 32] for i in range(n)], F.lit(""))
        for g in ("f", "m", "n"):
            end = _words(_ENDINGS[s, g])[v[7] % 4]
            names.append((holds & (F.col("gender") == g) & (kind == "given"), F.concat(stem, end)))
        names.append((holds & (kind == "family"), F.concat(stem, table[v[6] % 32])))
    name = reduce(lambda c, x: c.when(*x), names[1:], F.when(*names[0]))
    value = (F.when(kind.isin("given", "family"), name)
             .when(kind == "ip", octets)
             .when(kind == "card", card).otherwise(F.array_join("swap", "")))
    return e.withColumn("surrogate", F.when(kind.isin("ip", "given", "family"), value)
                        .otherwise(F.concat(value, tail))).drop("chars", "v", "swap")


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canonical, surrogate) of the different entities (kind, canonical,
    gender), checked for distinctness."""
    left, done = stored(entities, "entities"), None
    real = left.select(F.col("kind").alias("rk"), F.col("canonical").alias("rc"))
    # an e-mail's surrogate stands for the part before the @
    real = real.select("rk", F.when(F.col("rk") == "email", F.substring_index("rc", "@", 1))
                       .otherwise(F.col("rc")).alias("rc")).distinct()
    for attempt in range(MAX_ATTEMPTS):
        drawn = stored(draw(left, key, attempt), "drawn")
        first = drawn.groupBy(F.col("kind").alias("fk"), F.col("surrogate").alias("fs")).agg(
            F.min("canonical").alias("fc"))
        first = first.join(real, (F.col("fk") == F.col("rk")) & (F.col("fs") == F.col("rc")), "left_anti")
        if done is not None:
            taken = done.select(F.col("kind").alias("tk"), F.col("surrogate").alias("ts"))
            first = first.join(taken, (F.col("fk") == F.col("tk")) & (F.col("fs") == F.col("ts")), "left_anti")
        same = ((F.col("kind") == F.col("fk")) & (F.col("surrogate") == F.col("fs"))
                & (F.col("canonical") == F.col("fc")))
        judged = stored(drawn.join(first, same, "left").select(
            "kind", "canonical", "gender", "surrogate", F.col("fk").isNotNull().alias("free")), "judged")
        good = judged.where("free").select("kind", "canonical", "surrogate")
        done = good if done is None else done.unionByName(good)
        left = judged.where("not free").select("kind", "canonical", "gender")
        if left.isEmpty():
            return done
    raise RuntimeError(f"no distinct surrogates after {MAX_ATTEMPTS} attempts")


def dressed(kind: Column, original: Column, surrogate: Column) -> Column:
    """A surrogate in the case and with the separators of the original."""
    chars = _chars(original)
    # how many characters that the canonical form keeps stand before each
    keeps = F.when(kind.isin("phone", "ssn", "card"), F.lit(r"\D")).when(
        kind == "iban", F.lit(" ")).otherwise(F.lit(r"\z."))
    spread = F.transform(chars, lambda c, i: F.when(F.rlike(c, F.concat(F.lit(r"\A"), keeps)), c).otherwise(
        F.substring(surrogate, F.char_length(F.regexp_replace(
            F.substring(original, F.lit(1), i), keeps, F.lit(""))) + 1, F.lit(1))))
    cased = F.zip_with(spread, chars, lambda s, c: F.when(
        (F.upper(c) == c) & (F.lower(c) != c), F.upper(s)).otherwise(s))
    kept = F.char_length(F.regexp_replace(original, keeps, F.lit("")))
    longer = F.substring(surrogate, kept + 1, F.greatest(F.char_length(surrogate) - kept, F.lit(0)))
    loud = (F.upper(original) == original) & (F.char_length(original) > 1)
    return (F.when(kind.isin("given", "family"), F.when(loud, F.upper(surrogate)).otherwise(F.initcap(surrogate)))
            .when(kind == "ip", surrogate)
            .when(kind == "secret", F.when(F.rlike(original, F.lit(r"\A[0-9A-F]+\z")), F.upper(surrogate))
                  .otherwise(surrogate))
            .otherwise(F.concat(F.array_join(cased, ""), longer)))


def replace_private(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """``docs`` with surrogates in ``text``, and ``n_replaced``."""
    d = packed(docs, "doc_id", "text")
    d = d.select("*", *row_key(F.col("__doc_id"), F.col("__text")))
    found = d.select("__k1", "__k2", F.posexplode(
        F.regexp_extract_all("__text", F.lit(ANY), F.lit(0))).alias("at", "match"))
    found = found.withColumn("kind", kind_of(F.col("match")))
    found = found.select("__k1", "__k2", "at", "match", F.col("kind").alias("whole"),
                         F.posexplode(parts_of(F.col("kind"), F.col("match"))).alias("nr", "part"))
    found = stored(found.select("__k1", "__k2", "at", "match", "whole", "nr", "part.*"), "found")
    said = lambda g: F.sum((F.col("said") == g).cast("int"))
    entities = found.groupBy("kind", "canonical").agg(
        F.coalesce(F.when(said("f") > said("m"), "f").when(said("m") > 0, "m"), F.lit("n")).alias("gender"))
    drawn = stored(surrogates(entities, key).select(
        F.col("kind").alias("dk"), F.col("canonical").alias("dc"), "surrogate"), "surrogates")
    new = found.join(drawn, (F.col("kind") == F.col("dk")) & (F.col("canonical") == F.col("dc")))
    # one struct per part; a document's parts come together by place
    new = new.groupBy("__k1", "__k2").agg(F.array_sort(F.collect_set(F.struct(
        "at", "nr", "whole", "match",
        dressed(F.col("kind"), F.col("original"), F.col("surrogate")).alias("new")))).alias("parts"))
    new = stored(new.select(F.col("__k1").alias("k1"), F.col("__k2").alias("k2"), "parts"), "new")
    # texts are dealt out by key at every size, see line_dedup
    out = d.join(new.hint("merge"), (F.col("__k1") == F.col("k1")) & (F.col("__k2") == F.col("k2")), "left")
    # what stands before each part: the text between matches, and inside a
    # match its title, the @ or a space
    gaps = F.split("__text", ANY, -1)
    parts = F.col("parts")
    joined = F.transform(parts, lambda p, i: F.concat(
        F.when(p["nr"] > 0, F.when(p["whole"] == "email", "@").otherwise(" ")).otherwise(F.concat(
            F.when(i == 0, "").otherwise(_after(parts[F.greatest(i - 1, F.lit(0))])), gaps[p["at"]],
            F.when(p["whole"] == "name", F.regexp_extract(p["match"], rf"\A({_TITLE} )", 1)).otherwise(""))),
        p["new"]))
    text = F.concat(F.array_join(joined, ""), _after(F.element_at(parts, -1)), F.element_at(gaps, -1))
    text = F.when(parts.isNull(), F.col("__text")).otherwise(text)
    n = F.size(F.array_distinct(F.transform(parts, lambda p: p["at"])))
    return out.select(*unpacked(docs.columns, ["n_replaced"], text=text), F.when(parts.isNull(), 0).otherwise(n).alias("n_replaced"))


def _after(part: Column) -> Column:
    """What follows a match's last part: an address's top-level domain."""
    return F.when(part["whole"] == "email", F.regexp_extract(part["match"], r"(\.[^.]*)\z", 1)).otherwise("")
