"""Secret scans: three fixed patterns, and a battery of randomness tests over everything that could be an encoded key.

*Base spans.*  Assignments, access keys and hex runs, leftmost and non-overlapping for each pattern, with their code
point offsets from the lengths of the matches and of the text between them.

*Battery.*  Every run of at least ``MIN_LENGTH`` key characters is a candidate.  Its encoding is the smallest alphabet
of ``ENCODINGS`` that holds it, provided that it mixes what a key of that encoding mixes (digits and letters; upper and lower
case where both belong).  Under a uniform draw of symbols, three tests give p-values: chi-squared of the symbol
counts, number of runs of the alphabet's two halves, and serial correlation of neighbours; Fisher's method joins them.

*False-discovery control.*  Random strings have uniform p-values, whatever their length; words and names have small ones,
but less surely the shorter they are.  So for each encoding and class of lengths, the candidates of the whole corpus,
each different one once, tell how many random ones there are (those of p above a fifth and one standard deviation of
their number, over four fifths), and the acceptance bound is the least p at which at most ``FDR`` of what is accepted
is expected not to be random.  No bound lies below ``LEAST_P``; a class without any p above a fifth accepts nothing.

All in built-in functions.  A text is read once; its spans and candidates go to a table, from which the bounds are counted
(one row an encoding, length class and step of p, so the table of bounds is of fixed size) and the spans taken.

Nulls: a null text is empty and has no spans.  A null doc_id keeps its row.  Repeated rows each get a row.  Other columns
are not looked at.  An empty table gives an empty result.  A text of one very long key is one candidate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourmeter.llm.frames import saved


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: Names that a secret is assigned to.
NAMES = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = "(" + "|".join(map(_either_case, NAMES)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: kind, pattern; in this order.  An access key has 20 characters or more, a hex run 24, an assigned value 6.
PATTERNS = (("assign", ASSIGN), ("access", "AKIA[A-Z0-9]{16,}"), ("hex", "[0-9a-f]{24,}"))
LEAST_VALUE = 6
RANDOM = "random"

MIN_LENGTH = 20
CANDIDATE = f"[A-Za-z0-9+/_-]{{{MIN_LENGTH},}}"
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: name, alphabet, what a key of it holds; the first that fits is taken.
ENCODINGS = (
    ("hex", _DIGITS + _LOWER[:6], ("[0-9]", "[a-f]")),
    ("hexupper", _DIGITS + _UPPER[:6], ("[0-9]", "[A-F]")),
    ("base32", _UPPER + "234567", ("[2-7]", "[A-Z]")),
    ("base36", _DIGITS + _LOWER, ("[0-9]", "[a-z]")),
    ("base36upper", _DIGITS + _UPPER, ("[0-9]", "[A-Z]")),
    ("base62", _DIGITS + _UPPER + _LOWER, ("[0-9]", "[A-Z]", "[a-z]")),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/", ("[0-9]", "[A-Z]", "[a-z]")),
    ("base64url", _UPPER + _LOWER + _DIGITS + "-_", ("[0-9]", "[A-Z]", "[a-z]")),
)
FDR = 0.05
LEAST_P = 0.001
#: Steps of p in the counts, and the step above which candidates are held to be random ones.
STEPS, SURE = 100, 20
_PART = 512


def running(values: Column, zero: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """Each element merged with all before it, ``zero`` first (one element more than ``values``).  An array built up step
    by step is copied at each step, so parts of 512 elements are folded first and then set behind one another."""

    def fold(part: Column, start: Column) -> Column:
        return F.aggregate(part, F.array(start), lambda acc, x: F.concat(acc, F.array(merge(F.element_at(acc, -1), x))))

    last = F.floor(F.greatest(F.size(values) - 1, F.lit(0)) / _PART).cast("int")
    parts = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(values, k * _PART + 1, F.lit(_PART)))
    totals = F.transform(parts, lambda p: F.aggregate(p, zero, merge))
    starts = fold(totals, zero)
    inner = F.zip_with(parts, F.slice(starts, F.lit(1), F.size(parts)), lambda p, s: F.slice(fold(p, s), F.lit(2), F.size(p)))
    return F.concat(F.array(zero), F.flatten(inner))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), 0)


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches in order: array of (start, end, match), in code points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)

    def placed(m: Column) -> Column:
        sizes = F.transform(m, F.length)
        # a match starts after all gaps up to its own and all matches before it
        steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(m)), F.concat(F.array(F.lit(0)), F.slice(sizes, F.lit(1), F.greatest(F.size(m) - 1, F.lit(0)))), lambda g, x: (g + x).cast("long"))
        starts = F.slice(running(steps, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(2), F.size(m))
        return F.zip_with(starts, m, lambda at, x: F.struct(at.alias("start"), (at + F.length(x)).alias("end"), x.alias("match")))

    none = F.array().cast("array<struct<start:bigint,end:bigint,match:string>>")
    return F.when(text.rlike(pattern), _let(found, placed)).otherwise(none)


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns, by start and then kind as listed: array of (start, place, end)."""

    def of_kind(place: int, kind: str, pattern: str) -> Column:
        found = matches(text, pattern)
        if kind == "assign":
            found = F.filter(found, lambda m: F.length(F.regexp_extract(m["match"], ASSIGN, 2)) >= LEAST_VALUE)
        return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(place).alias("place"), m["end"].alias("end")))

    return F.array_sort(F.concat(*[of_kind(place, *p) for place, p in enumerate(PATTERNS)]))


def _upper_tail(z: Column) -> Column:
    """P(Z >= z) of a normal Z, by a polynomial in 1 / (1 + 0.2316419 |z|)."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-x * x / 2) * poly / (2 * 3.141592653589793) ** 0.5
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _by_encoding(value: Callable[[str, str], Column], name: Column) -> Column:
    out = F.lit(None)
    for kind, alphabet, _ in reversed(ENCODINGS):
        out = F.when(name == kind, value(kind, alphabet)).otherwise(out)
    return out


def encoding(key: Column) -> Column:
    """Name of the first encoding that holds the key; null if none does."""
    out = F.lit(None).cast("string")
    for kind, alphabet, parts in reversed(ENCODINGS):
        fits = F.translate(key, alphabet, "") == ""
        for part in parts:
            fits = fits & key.rlike(part)
        out = F.when(fits, F.lit(kind)).otherwise(out)
    return out


def randomness(key: Column, name: Column) -> Column:
    """Joint p-value of the three tests for a key of at least four characters in the encoding ``name``."""

    def chi_squared(k: Column) -> Column:
        a = F.size(k["symbols"]).cast("double")
        squares = F.aggregate(k["symbols"], F.lit(0.0), lambda acc, s: acc + F.pow(k["n"] - F.length(F.replace(k["key"], s, F.lit(""))), F.lit(2.0)))
        x = a / k["n"] * squares - k["n"]
        # Wilson and Hilferty's cube root, with the variance that n draws have
        free = (a - 1) * k["n"] / (k["n"] - 1)
        x = x * k["n"] / (k["n"] - 1)
        z = (F.pow(F.greatest(x, F.lit(0.0)) / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
        return _upper_tail(z)

    def runs(k: Column) -> Column:
        ones = F.length(F.replace(k["halves"], F.lit("0"), F.lit(""))).cast("double")
        mean = 1 + 2 * ones * (k["n"] - ones) / k["n"]
        spread = (mean - 1) * (mean - 2) / (k["n"] - 1)
        n_runs = F.regexp_count(k["halves"], F.lit("0+")) + F.regexp_count(k["halves"], F.lit("1+"))
        return F.when(spread > 0, 2 * _upper_tail(F.abs(n_runs - mean) / F.sqrt(spread))).otherwise(0.0)

    def serial(k: Column) -> Column:
        x = k["values"]
        total = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v)
        squares = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v * v)
        shifted = F.concat(F.slice(x, F.lit(2), F.greatest(F.size(x) - 1, F.lit(0))), F.slice(x, F.lit(1), F.lit(1)))
        products = F.aggregate(F.zip_with(x, shifted, lambda u, v: u * v), F.lit(0.0), lambda acc, v: acc + v)
        n, below = k["n"], k["n"] * squares - total * total
        z = ((n * products - total * total) / below + 1 / (n - 1)) / F.sqrt(n * n / ((n - 1) * (n - 1) * (n - 2)))
        return F.when(below > 0, 2 * _upper_tail(F.abs(z))).otherwise(0.0)

    def joint(k: Column) -> Column:
        logs = [F.log(F.greatest(F.least(p, F.lit(1.0)), F.lit(1e-300))) for p in (chi_squared(k), runs(k), serial(k))]
        half = -(logs[0] + logs[1] + logs[2])
        return _let(half, lambda h: F.exp(-h) * (1 + h + h * h / 2))

    alphabet = _by_encoding(lambda _, s: F.lit(s), name)
    halves = _by_encoding(lambda _, s: F.translate(key, s, "0" * (len(s) // 2) + "1" * (len(s) - len(s) // 2)), name)
    symbols = F.filter(F.split(alphabet, ""), lambda c: c != "")
    characters = F.filter(F.split(key, ""), lambda c: c != "")
    stated = F.struct(
        key.alias("key"), F.length(key).cast("double").alias("n"), symbols.alias("symbols"), halves.alias("halves"), F.transform(characters, lambda c: (F.instr(alphabet, c) - 1).cast("double")).alias("values")
    )
    return _let(stated, joint)


def _step(p: Column) -> Column:
    """The step of p: 0 below LEAST_P, then one for each hundredth."""
    return F.when(p < LEAST_P, 0).otherwise(F.least(F.floor(p * STEPS), F.lit(STEPS - 1)) + 1).cast("int")


def candidates(text: Column) -> Column:
    """Keys to be tested: array of (start, end, encoding, length_class, p, id)."""

    def tested(m: Column) -> Column:
        return _let(
            F.struct(m["start"].alias("start"), m["end"].alias("end"), m["match"].alias("match"), encoding(m["match"]).alias("encoding")),
            lambda k: F.struct(
                k["start"].alias("start"),
                k["end"].alias("end"),
                k["encoding"].alias("encoding"),
                F.floor(2 * F.log2(F.length(k["match"]).cast("double"))).cast("int").alias("length_class"),
                F.when(k["encoding"].isNotNull(), randomness(k["match"], k["encoding"])).alias("p"),
                F.xxhash64(k["match"]).alias("id"),
            ),
        )

    return F.filter(F.transform(matches(text, CANDIDATE), tested), lambda k: k["encoding"].isNotNull())


def bounds(scanned: DataFrame) -> DataFrame:
    """(encoding, length_class, step): candidates of that step and above are accepted; a class without a bound has no row."""
    each = scanned.select(F.explode("candidates").alias("k")).select("k.encoding", "k.length_class", _step(F.col("k.p")).alias("step"), "k.id").distinct()
    counted = each.groupBy("encoding", "length_class", "step").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("encoding", "length_class")  # at most STEPS + 1 rows
    upper = F.sum(F.when(F.col("step") > SURE, F.col("n")).otherwise(0)).over(group)
    accepted = F.sum("n").over(group.orderBy(F.desc("step")))
    least = F.when(F.col("step") == 1, F.lit(LEAST_P)).otherwise((F.col("step") - 1) / F.lit(float(STEPS)))
    expected = (upper + F.sqrt(upper)) * (STEPS / (STEPS - SURE)) * (1 - least)
    fits = (F.col("step") > 0) & (1 - expected / accepted <= FDR)
    return counted.withColumn("fits", fits).where("fits").groupBy("encoding", "length_class").agg(F.min("step").alias("step"))


def scan(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, base (array of kind, start, end) and added (with encoding
    and p): random keys that don't lie inside a base span."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    scanned = saved(spark, rows.select("doc_id", base_spans(F.col("text")).alias("base"), candidates(F.col("text")).alias("candidates")), "secret-scan")
    accepted = {(r["encoding"], r["length_class"]): r["step"] for r in bounds(scanned).collect()}  # at most 64 classes an encoding
    flat = [x for (kind, size), step in sorted(accepted.items()) for x in (F.lit(f"{kind}:{size}"), F.lit(step))]
    table = F.create_map(*flat) if flat else F.create_map().cast("map<string,int>")
    chosen = F.filter("candidates", lambda k: _step(k["p"]) >= F.try_element_at(table, F.concat_ws(":", k["encoding"], k["length_class"].cast("string"))))
    # along all spans by start, the farthest end of a base span so far tells whether a key lies inside one
    spans = F.transform("base", lambda b: F.struct(b["start"].alias("start"), F.lit(0).alias("own"), b["end"].alias("end"), F.lit(None).cast("string").alias("encoding"), F.lit(None).cast("double").alias("p")))
    keys = F.transform("chosen", lambda k: F.struct(k["start"].alias("start"), F.lit(1).alias("own"), k["end"].alias("end"), k["encoding"].alias("encoding"), k["p"].alias("p")))

    def outside(line: Column) -> Column:
        reach = running(F.transform(line, lambda s: F.when(s["own"] == 0, s["end"]).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, x: F.greatest(a, x))
        met = F.zip_with(line, F.slice(reach, F.lit(2), F.size(line)), lambda s, r: F.when((s["own"] == 1) & (s["end"] > r), s))
        return F.filter(met, lambda s: s.isNotNull())

    out = scanned.withColumn("chosen", chosen)
    empty = F.array().cast("array<struct<start:bigint,own:int,end:bigint,encoding:string,p:double>>")
    added = F.when(F.size("chosen") > 0, _let(F.array_sort(F.concat(spans, keys)), outside)).otherwise(empty)
    kind = lambda b: F.element_at(F.array(*[F.lit(k) for k, _ in PATTERNS]), b["place"] + 1)
    return out.select(
        "doc_id",
        F.transform("base", lambda b: F.struct(kind(b).alias("kind"), b["start"].alias("start"), b["end"].alias("end"))).alias("base"),
        F.transform(added, lambda s: F.struct(F.lit(RANDOM).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["encoding"].alias("encoding"), s["p"].alias("p"))).alias("added"),
    )


def told(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def in_order(base: Column, added: Column) -> Column:
    """Both arrays' spans as (kind, start, end), by start, then kind as listed, the added kind last."""
    names = [k for k, _ in PATTERNS] + [RANDOM]
    place = lambda s: F.array_position(F.array(*[F.lit(k) for k in names]), s["kind"])
    keyed = F.concat(*[F.transform(x, lambda s: F.struct(s["start"].alias("start"), place(s).alias("place"), s["end"].alias("end"), s["kind"].alias("kind"))) for x in (base, added)])
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
