"""Secrets in texts: three fixed patterns, and tokens that pass a battery of randomness tests.

Everything is a DataFrame expression. Spans are in code points, the end exclusive.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bondscope.llm.common import stored

#: Fixed patterns of the base kinds, in their order: pattern, group whose length counts, least length.
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12)
ACCESS = (r"AKIA[A-Z0-9]+", 0, 18)
HEX = (r"[0-9a-f]+", 0, 16)
BASE = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
#: The same matches of ACCESS and HEX that are long enough; short runs need no array then.
LONG = {"access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}

RANDOM = "random"
TOKEN = r"[A-Za-z0-9+/_-]{16,}={0,2}"
#: Encodings in the order they are tried: name, tokens, and the number of lower vowels, lower
#: consonants, upper vowels, upper consonants, digits and marks among their symbols.
ENCODINGS = (
    ("hex", r"^[0-9a-f]+$", (2, 4, 0, 0, 10, 0)),
    ("upper hex", r"^[0-9A-F]+$", (0, 0, 2, 4, 10, 0)),
    ("base32", r"^[A-Z2-7]+=*$", (0, 0, 5, 21, 6, 0)),
    ("base36", r"^[0-9a-z]+$", (5, 21, 0, 0, 10, 0)),
    ("upper base36", r"^[0-9A-Z]+$", (0, 0, 5, 21, 10, 0)),
    ("base62", r"^[0-9A-Za-z]+$", (5, 21, 5, 21, 10, 0)),
    ("base64", r"^[0-9A-Za-z+/]+=*$", (5, 21, 5, 21, 10, 2)),
    ("url base64", r"^[0-9A-Za-z_-]+=*$", (5, 21, 5, 21, 10, 2)),
)
CELLS = ("lv", "lc", "uv", "uc", "d", "m")
BINS = 100
LIKELY = 0.5
FALSE_SHARE = 0.05
BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often the body or a lambda in it reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(sizes: Column) -> Column:
    """Running sums of a non-empty array of longs, by blocks: no element adds more than two short slices."""
    total = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda s, x: s + x)
    count = lambda a: F.sequence(F.lit(0), F.size(a) - 1)

    def summed(given: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.size(given) - 1, F.lit(BLOCK)), lambda at: total(F.slice(given, at + 1, F.lit(BLOCK))))
        before = let(blocks, lambda b: F.transform(count(b), lambda i: total(F.slice(b, F.lit(1), i))))
        return let(before, lambda b: F.transform(given, lambda _, i: F.get(b, F.floor(i / BLOCK).cast("int")) + total(
            F.slice(given, i - i % BLOCK + 1, i % BLOCK + 1))))

    return let(sizes, summed)


def located(text: Column, pattern: str) -> Column:
    """Array of (start, end, token) of the leftmost matches of a pattern that never matches nothing.

    Spark has no function for the places of all matches, so they are added up from the
    lengths of the matches and of the pieces between them.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def places(found: Column) -> Column:
        steps = F.transform(F.arrays_zip(
            F.slice(F.transform(F.split(text, pattern), lambda p: F.length(p)), F.lit(1), F.size(found)).alias("gap"),
            found.alias("token")), lambda z: (z["gap"] + F.length(z["token"])).cast("long"))
        return let(running(steps), lambda ends: F.transform(found, lambda token, i: F.struct(
            (F.get(ends, i) - F.length(token)).alias("start"), F.get(ends, i).alias("end"), token.alias("token"))))

    none = F.array().cast("array<struct<start:bigint,end:bigint,token:string>>")
    return F.when(text.rlike(pattern), let(matches, places)).otherwise(none)


def base_spans(text: Column, kind: str) -> Column:
    pattern, group, least = BASE[kind]
    if kind in LONG:
        return located(text, LONG[kind])
    return F.filter(located(text, pattern), lambda s: F.length(F.regexp_extract(s["token"], pattern, group)) >= least)


def _tail(z: Column) -> Column:
    """Chance of a normal number beyond +-z: Abramowitz and Stegun 7.1.26, error below 2e-7."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1 / (1 + 0.3275911 * x)
    poly = F.lit(0.0)
    for a in (1.061405429, -1.453152027, 1.421413741, -0.284496736, 0.254829592):
        poly = (poly + a) * t
    return F.least(F.lit(1.0), poly * F.exp(-x * x))


def _chance(x: Column, sizes: Column) -> Column:
    """Chance of a token at least this odd among random tokens of an encoding with these symbols.

    ``x`` holds the counts of the token, ``sizes`` the numbers of symbols, both in CELLS.
    """
    n = x["n"]
    k = sum((sizes[c] for c in CELLS), F.lit(0.0))
    shares = F.transform(F.array(*[sizes[c] for c in CELLS]), lambda size: size / k)
    # Wilson and Hilferty: the cube root of chi-squared over its degrees is nearly normal.
    terms = F.filter(F.zip_with(F.array(*[x[c] for c in CELLS]), shares, lambda o, p: F.struct(
        o.alias("o"), (n * p).alias("e"))), lambda t: t["e"] > 0)
    free = lambda t: F.size(t) - 1.0
    chi = lambda t: F.aggregate(t, F.lit(0.0), lambda s, c: s + (c["o"] - c["e"]) * (c["o"] - c["e"]) / c["e"])
    spread = lambda t: 2 / (9 * free(t))
    z = let(terms, lambda t: (F.cbrt(chi(t) / free(t)) - (1 - spread(t))) / F.sqrt(spread(t)))
    uniform = let(z, lambda v: F.when(v > 0, _tail(v) / 2).otherwise(1 - _tail(v) / 2))
    kinds = F.transform(
        F.array(sizes["lv"] + sizes["lc"], sizes["uv"] + sizes["uc"], sizes["d"], sizes["m"]), lambda size: size / k)
    power = lambda e: F.aggregate(kinds, F.lit(0.0), lambda s, p: s + F.pow(p, F.lit(e)))
    moments = F.struct(power(2.0).alias("two"), power(3.0).alias("three"))
    runs = let(moments, lambda m: _tail(
        (x["runs"] - 1 - (n - 1) * (1 - m["two"])) / F.sqrt(
            (n - 1) * m["two"] * (1 - m["two"]) + 2 * (n - 2) * (m["three"] - m["two"] * m["two"]))))
    serial = F.coalesce(_tail((x["r"] + 1 / n) * F.sqrt(n)), F.lit(0.0))
    # Cauchy combination: right in its tail however the tests depend on each other.
    inside = F.transform(F.array(uniform, runs, serial), lambda p: F.greatest(F.least(p, F.lit(1 - 1e-9)), F.lit(1e-15)))
    mean = F.aggregate(inside, F.lit(0.0), lambda s, p: s + F.tan((0.5 - p) * F.pi()) / 3)
    return 0.5 - F.atan(mean) / F.pi()


def tested(token: Column) -> Column:
    """Struct (encoding, band, p) of a token; encoding null if it is in none or lacks digits or letters.

    The battery: chi-squared of the symbols over vowels, consonants, digits and marks, the
    number of runs of one class, and the serial correlation of the symbols. ``band`` is
    the power of two below the length.
    """
    body = F.regexp_replace(token, "=+$", "")
    length = F.length(body).cast("double")
    count = lambda symbols: length - F.length(F.translate(body, symbols, ""))
    lower, upper = count("abcdefghijklmnopqrstuvwxyz"), count("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    digits, vowels, capitals = count("0123456789"), count("aeiou"), count("AEIOU")
    classes = body
    for symbols, one in (("[a-z]+", "a"), ("[A-Z]+", "A"), ("[0-9]+", "0"), ("[+/_-]+", "-")):
        classes = F.regexp_replace(classes, symbols, one)
    codes = F.transform(F.filter(F.split(body, ""), lambda c: c != ""), lambda c: F.ascii(c).cast("double"))
    plus = lambda s, x: s + x

    def lagged(v: Column) -> Column:
        mean = F.aggregate(v, F.lit(0.0), plus) / F.size(v)
        moved = lambda m: F.transform(v, lambda x: x - m)
        products = lambda d: F.zip_with(F.slice(d, F.lit(1), F.size(d) - 1), F.slice(d, F.lit(2), F.size(d) - 1),
                                        lambda x, y: x * y)
        squares = lambda d: F.aggregate(d, F.lit(0.0), lambda s, x: s + x * x)
        return let(mean, lambda m: let(moved(m), lambda d: F.when(
            squares(d) > 0, F.aggregate(products(d), F.lit(0.0), plus) / squares(d))))

    numbers = F.struct(
        length.alias("n"), vowels.alias("lv"), (lower - vowels).alias("lc"), capitals.alias("uv"),
        (upper - capitals).alias("uc"), digits.alias("d"), (length - lower - upper - digits).alias("m"),
        F.length(classes).cast("double").alias("runs"), let(codes, lagged).alias("r"))

    def judged(x: Column) -> Column:
        chosen = F.lit(None).cast("struct<name:string," + ",".join(f"{c}:double" for c in CELLS) + ">")
        for encoding, tokens, sizes in reversed(ENCODINGS):
            known = F.struct(F.lit(encoding).alias("name"), *[F.lit(float(s)).alias(c) for c, s in zip(CELLS, sizes)])
            chosen = F.when(token.rlike(tokens), known).otherwise(chosen)
        mixed = (x["d"] > 0) & (x["d"] < x["n"])
        return let(F.when(mixed, chosen), lambda e: F.struct(
            e["name"].alias("encoding"), F.floor(F.log2(x["n"])).cast("int").alias("band"), _chance(x, e).alias("p")))

    return let(numbers, judged)


def cutoffs(tokens: DataFrame) -> DataFrame:
    """Least chance of reported tokens for each (encoding, band) of ``tokens``, if there is one.

    Chances of random tokens are even over 0 to 1 and others lie near 0, so those above LIKELY
    tell how many random ones there are in all. From the cutoff up, at most FALSE_SHARE of the
    tokens are others. Each encoding and length has its own cutoff, as short tokens are
    harder to tell apart. At most BINS rows for each of them are sorted.
    """
    counts = tokens.groupBy("encoding", "band", F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).alias("bin")).agg(
        F.count("*").alias("n"))
    stratum = Window.partitionBy("encoding", "band")
    above = F.sum("n").over(stratum.orderBy(F.desc("bin")))
    random = F.sum(F.when(F.col("bin") >= LIKELY * BINS, F.col("n")).otherwise(0)).over(stratum) / (1 - LIKELY)
    least = F.col("bin") / BINS
    found = counts.select("encoding", "band", least.alias("cutoff"), above.alias("above"), random.alias("random"))
    others = 1 - F.col("random") * (1 - F.col("cutoff")) / F.col("above")
    return found.where(others <= FALSE_SHARE).groupBy("encoding", "band").agg(F.min("cutoff").alias("cutoff"))


def _ranked(found: str | Column, rank: int, kind: str) -> Column:
    return F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"),
        s["token"].alias("token")))


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans`` of every row of ``docs`` (doc_id, text).

    ``spans`` is an array of (start, kind, end, token), by start, then kind in the order assign,
    access, hex, random. The base kinds are the leftmost non-overlapping matches of their
    patterns that are long enough. A token of 16 or more symbols of one encoding, with digits
    and letters, is random if it passes the tests at the cutoff of its encoding and length over
    all rows, and meets no base span. Null and empty texts have no spans; rows that repeat
    are scanned and counted each for itself; texts of any length are read whole. Further
    columns are ignored, whatever their names; an empty table gives no rows.
    """
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    spans = given.select("doc_id", *[base_spans(F.col("text"), kind).alias(kind) for kind in BASE],
                         located(F.col("text"), TOKEN).alias("tokens"))
    clear = lambda s: ~F.exists(F.concat(*BASE), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    likely = F.filter("tokens", lambda s: s["token"].rlike("[0-9]") & s["token"].rlike("[A-Za-z]"))
    spans = spans.withColumn("tokens", F.transform(F.filter(likely, clear), lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["token"].alias("token"), tested(s["token"]).alias("test"))))
    # The texts are read once: what was found in them is stored, without the texts.
    spans = stored(spans, "spans")
    tokens = spans.select(F.explode("tokens.test").alias("t")).select("t.*").where("encoding IS NOT NULL")
    rows = cutoffs(tokens).collect()  # at most one for each encoding and power of two
    pairs = [F.lit(x) for r in rows for x in (f"{r.encoding} {r.band}", r.cutoff)]
    limits = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,double>")
    limit = lambda t: F.try_element_at(limits, F.concat_ws(" ", t["encoding"], t["band"]))
    passed = F.filter("tokens", lambda s: F.coalesce(s["test"]["p"] >= limit(s["test"]), F.lit(False)))
    ranked = [_ranked(found, rank, kind) for rank, (kind, found) in enumerate([*((k, k) for k in BASE), (RANDOM, passed)])]
    return spans.select("doc_id", F.transform(F.array_sort(F.concat(*ranked)), lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["token"].alias("token"))).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
