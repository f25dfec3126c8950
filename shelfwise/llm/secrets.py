"""Secret scans: fixed patterns, and a battery of randomness tests on long tokens.

The base patterns find assignments, access keys and long hexadecimal runs. Every
other token of 20 characters or more that holds a letter is tested against the
encoding its characters suggest: chi-squared for a uniform use of the alphabet
(in eight equal ranges), the runs test on its upper and lower half, and the
serial correlation of neighbours. Fisher's method combines the three into the
probability p that random characters look at least as uneven. Alphabets list
letters by how common they are in prose, as in that order the ranges and the
correlation tell words from random letters; to random characters any order is one.

Random tokens have an even p, others a small one. How many of the others reach a
threshold t is read off the tokens below it: on the scale of -log p they thin out
towards 0, so no more of them lie in [t, 1] than in [t^2, t), or than half of
those in [t^3, t), or a third of those in [t^4, t), as far as these ranges do not
go below 0.0001; what random tokens add to them is taken off. A class of encoding
and length accepts tokens from the smallest threshold on at which at most ``fdr``
of those accepted are expected to be no secrets. So one secret far from the others
is found without any like it, and short tokens, on which tests have little power,
face their own threshold. A class with few others borrows those of the nearest
lengths. Classes are counted over the whole table, by different tokens; a class
is one of a fixed number, so their table is small whatever the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import keyed, stage

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]{20})(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]++={0,2}"

DIGITS = "0123456789"
#: Letters from common to rare.
COMMON = "etaoinsrhldcumfpgwybvkxjqz"
#: Encodings by the characters they use; the first that fits is inferred.
ENCODINGS = (
    ("lower_letters", "^[a-z]+$", COMMON),
    ("upper_letters", "^[A-Z]+$", COMMON.upper()),
    ("letters", "^[A-Za-z]+$", COMMON + COMMON.upper()),
    ("hex", "^[0-9a-f]+$", DIGITS + "abcdef"),
    ("hex_upper", "^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("base32", "^[A-Z2-7]+$", COMMON.upper() + "234567"),
    ("lower", "^[0-9a-z]+$", COMMON + DIGITS),
    ("upper", "^[0-9A-Z]+$", COMMON.upper() + DIGITS),
    ("base62", "^(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z]+$", COMMON + COMMON.upper() + DIGITS),
    ("base64", "^(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z+/]+$", COMMON + COMMON.upper() + DIGITS + "+/"),
    ("base64url", "^(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z_-]+$", COMMON + COMMON.upper() + DIGITS + "-_"),
)
RANGES = 8
LENGTHS = (24, 32, 40, 64, 128)
#: Thresholds that a class may have, and for each how far below it tokens are looked at: to its powers of 1 + these numbers.
LEVELS = (0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7)
DEPTHS = {t: [d for d in (1, 2, 3) if t ** (d + 1) >= LEVELS[0] ** 2] for t in LEVELS}
#: Tokens below all thresholds that a class needs to stand alone.
ENOUGH = 20

SPANS = "array<struct<start:int,end:int,rank:int>>"


def spans(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """(start, end, value) of the leftmost matches, in code points: what lies between them, and they themselves, add up to the places."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    # The arrays are arguments, not parts of the function, so each is made once per text.
    parts = F.arrays_zip(F.split(text, pattern).alias("between"), whole.alias("whole"), value.alias("value"))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def step(state: Column, x: Column) -> Column:
        low = state["at"] + F.char_length(x["between"])
        high = low + F.char_length(x["whole"])
        item = F.struct(low.alias("start"), high.alias("end"), x["value"].alias("value"))
        kept = F.when(F.char_length(x["value"]) >= least, F.array_append(state["out"], item)).otherwise(state["out"])
        return F.when(x["whole"].isNull(), state).otherwise(F.struct(high.alias("at"), kept.alias("out")))

    every = F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda s: s["out"])
    return F.when(text.rlike(pattern), every).otherwise(none)


def normal_tail(z: Column) -> Column:
    """The chance of a standard normal number above ``z`` (Zelen and Severo's polynomial, error below 1e-7)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = 0.3989422804014327 * F.exp(-z * z / 2) * poly
    return F.when(z >= 0, upper).otherwise(1 - upper)


def combined(places: str, size: str) -> Column:
    """Fisher's combination of the three tests on the column ``places`` in an alphabet of ``size`` characters."""
    size, n = F.col(size).cast("double"), F.size(places).cast("double")
    middle, spread = (size - 1) / 2, (size * size - 1) / 12

    def range_part(total: Column, b: Column) -> Column:
        share = (F.ceil((b + 1) * size / RANGES) - F.ceil(b * size / RANGES)) / size
        seen = F.size(F.filter(places, lambda x: F.floor(x * RANGES / size) == b))
        return total + (seen - n * share) * (seen - n * share) / (n * share)

    chi = F.aggregate(F.sequence(F.lit(0), F.lit(RANGES - 1)), F.lit(0.0), range_part)
    wilson = 2 / (9 * (RANGES - 1))
    uneven = normal_tail((F.pow(chi / (RANGES - 1), F.lit(1 / 3)) - (1 - wilson)) / wilson**0.5)
    pairs = F.zip_with(F.slice(places, 1, F.size(places) - 1), F.slice(places, 2, F.size(places) - 1), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    high = F.size(F.filter(places, lambda x: x >= size / 2)).cast("double")
    turns = F.size(F.filter(pairs, lambda p: (p["x"] >= size / 2) != (p["y"] >= size / 2)))
    both = 2 * high * (n - high)
    wide = F.sqrt(both * (both - n) / (n * n * (n - 1)))
    runs = F.when(both > n, 2 * normal_tail(F.abs((turns - both / n) / wide))).otherwise(0.0)
    products = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + (p["x"] - middle) * (p["y"] - middle))
    serial = 2 * normal_tail(F.abs(products / (F.sqrt(n - 1) * spread)))
    least = F.lit(1e-300)
    half = -(F.log(F.greatest(uneven, least)) + F.log(F.greatest(runs, least)) + F.log(F.greatest(serial, least)))
    return F.exp(-half) * (1 + half + half * half / 2)


def tested(tokens: DataFrame) -> DataFrame:
    """``tokens`` (value, ...) with the class of encoding and length and the combined p; tokens of no encoding are left out."""
    bare = F.regexp_replace("value", "=+$", "")
    letters = encoding = F.lit(None).cast("string")
    for name, fits, alphabet in reversed(ENCODINGS):
        letters = F.when(F.col("bare").rlike(fits), F.lit(alphabet)).otherwise(letters)
        encoding = F.when(F.col("bare").rlike(fits), F.lit(name)).otherwise(encoding)
    band = F.lit(0)
    for length in LENGTHS:
        band = band + (F.char_length("bare") >= length).cast("int")
    known = tokens.withColumn("bare", bare).withColumns({"letters": letters, "class": F.concat_ws("/", encoding, band.cast("string"))})
    places = F.transform(F.split("bare", ""), lambda c: F.call_function("instr", F.col("letters"), c) - 1)
    known = known.where("letters IS NOT NULL").withColumns({"places": places, "letter_count": F.char_length("letters")})
    known = stage(known.drop("bare", "letters"), "places")
    return known.withColumn("p", combined("places", "letter_count")).drop("places", "letter_count")


def thresholds(tokens: DataFrame, fdr: float) -> DataFrame:
    """One row with a map from class to the smallest p it accepts; classes that accept nothing are left out.

    ``tokens`` has (class, p), a row per different token.
    """
    p, widest = F.col("p"), len(LENGTHS)
    tallies = {"others": p < LEVELS[0]}
    for i, t in enumerate(LEVELS):
        tallies[f"above{i}"] = p >= t
        tallies |= {f"below{i}_{d}": (p < t) & (p >= t ** (d + 1)) for d in DEPTHS[t]}
    counts = tokens.groupBy("class").agg(*(F.count(F.when(held, 1)).alias(name) for name, held in tallies.items()))
    # Each class adds its counts to all lengths of its encoding, at the radius from which they include it.
    parts = F.substring_index("class", "/", 1).alias("encoding"), F.substring_index("class", "/", -1).cast("int").alias("band")
    pools = counts.select(*parts, F.explode(F.sequence(F.lit(0), F.lit(widest))).alias("radius"), *tallies)
    pools = pools.withColumn("band", F.explode(F.sequence(F.col("band") - F.col("radius"), F.col("band") + F.col("radius"))))
    pools = pools.groupBy("encoding", "band", "radius").agg(*(F.sum(name).alias(name) for name in tallies))
    accept = F.lit(None).cast("double")
    for i, t in reversed(list(enumerate(LEVELS))):
        above, wrong = F.col(f"above{i}"), F.lit(0.0)
        for d in DEPTHS[t]:
            # Random tokens in the range below for each one above; the rest below is d times what reaches above.
            share = (t - t ** (d + 1)) / (1 - t)
            wrong = F.greatest(wrong, (F.col(f"below{i}_{d}") - share * above) / (d - share))
        accept = F.when((above > 0) & (wrong <= fdr * above), F.lit(t)).otherwise(accept)
    alone = pools.where((F.col("others") >= ENOUGH) | (F.col("radius") == widest)).where(F.col("band").between(0, widest))
    name = F.concat_ws("/", "encoding", F.col("band").cast("string")).alias("class")
    rows = alone.groupBy(name).agg(F.min_by(accept, "radius").alias("least")).where("least IS NOT NULL")
    return rows.agg(F.map_from_entries(F.collect_list(F.struct("class", "least"))).alias("least"))


def _ranked(kind: str, rank: int) -> Column:
    return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(rank).alias("rank")))


def count_of(found: str, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["rank"] == KINDS.index(kind))).cast("long")


def find(docs: DataFrame, fdr: float = 0.1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, base, added) for every row of ``docs``: arrays of (start, end, rank) in code points, end exclusive.

    ``rank`` is the place of the kind in ``KINDS``. Base spans are the leftmost
    non-overlapping matches of each pattern; added ones are accepted tokens that
    overlap no base span. Null counts as empty. Repeated rows are scanned each;
    an empty table gives an empty result; other columns are not read.
    """
    rows = keyed(docs, id=id_col, text=text_col).select("id", F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")
    arrays = {"assign": spans(text, ASSIGN, 2, 6), "access": spans(text, ACCESS), "hex": spans(text, HEX), "random": spans(text, TOKEN)}
    read = rows.select("id", F.monotonically_increasing_id().alias("row"), *(v.alias(k) for k, v in arrays.items()))
    read = stage(read, "scanned")
    read = read.withColumn("base", F.concat(*(_ranked(kind, rank) for rank, kind in enumerate(KINDS[:3]))))
    free = F.filter("random", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    each = read.where(F.size("random") > 0).select("row", F.explode(free).alias("t")).select("row", "t.*")
    each = stage(tested(each).withColumn("name", F.xxhash64("value")).drop("value"), "tested")
    least = thresholds(each.groupBy("name", "class").agg(F.min("p").alias("p")), fdr)
    each = each.withColumn("least", F.element_at(stage(least, "thresholds").scalar(), F.col("class")))
    span = F.struct("start", "end", F.lit(len(KINDS) - 1).alias("rank"))
    added = each.where("p >= least").groupBy("row").agg(F.collect_list(span).alias("added"))
    found = read.select("id", "row", "base").join(added, "row", "left")
    return found.select(F.col("id").alias(id_col), "base", F.coalesce("added", F.array().cast(SPANS)).alias("added"))


def written(found: Column) -> Column:
    """``kind:start:end`` by start, then kind, joined with commas."""
    ordered = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"))))
    name = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.get(name, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
