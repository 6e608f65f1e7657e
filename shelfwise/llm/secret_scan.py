"""Secret scans: fixed patterns, and a battery of randomness tests on what they do not cover.

The patterns give spans of the kinds ``assign``, ``access`` and ``hex``. Every other run of 20 or more token
characters with a letter and a digit is a candidate. Its encoding is inferred from its characters (hexadecimal, base
32, base 36, base 62, base 64) and the battery asks whether it was drawn evenly from that alphabet: chi-squared
uniformity of the characters and of their classes (frequent and rare letters in either case, digits, signs), the
number of runs above and below the middle of the alphabet, and the correlation of neighbours. The p-values are
combined (Fisher); the combined value is near 1 for random strings and tiny for readable ones.

Its meaning is measured, as the error to bound is a readable string that is reported. For each class of lengths the
null hypothesis is the battery's value on readable runs: all words of all documents joined the way identifiers and paths
are, cut end to end into runs of the reference lengths so that no letter is left out, and the runs of ``PRIOR_TEXTS``
texts of common words, so that a small table has a null too. The lower half of the logarithm of -log10 p is fitted by a normal
curve, which gives each candidate its probability as a readable string. The Benjamini-Hochberg step then bounds,
within each class of lengths, the share of readable strings among the ``random`` spans reported. A class beyond the
longest reference uses that reference, which is strict, as longer readable strings are told more easily.

The curves and thresholds are read from counts of p-values on a logarithmic grid (classes times ``GRID`` rows at
most), so candidates are never sorted or gathered; counts cover all documents.

Positions are code points, ends exclusive. Defined cases: a null text is empty; equal rows are scanned alike; columns
of the input with the name of an output column are replaced; an empty table gives no rows. A very long text is one
row and is scanned whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import let, others
from shelfwise.operators.materialise import settle

KINDS = ("assign", "access", "hex", "random")
ASSIGN = (r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
          r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
MIN_RANDOM = 20
FALSE_SHARE = 0.01
PRIOR_TEXTS = 4000
GRID = 400
P_FLOOR = 1e-40

HEX_LOWER, HEX_UPPER = "0123456789abcdef", "0123456789ABCDEF"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE36 = "abcdefghijklmnopqrstuvwxyz0123456789"
BASE62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
BASE64 = BASE62 + "+/-_"
FREQUENT, SELDOM = "etaoinsrhl", "bcdfgjkmpquvwxyz"
CLASSES = {"a": FREQUENT, "b": SELDOM, "A": FREQUENT.upper(), "B": SELDOM.upper(), "0": "0123456789", "+": "+/-_"}
ALPHABETS = (HEX_LOWER, HEX_UPPER, BASE32, BASE36, BASE62, BASE64)
CLASS_FROM = "".join(CLASSES.values())
CLASS_TO = "".join(mark * len(held) for mark, held in CLASSES.items())
# The shortest length of each class of lengths that has readable references.
REFERENCE_LENGTHS = {8: 20, 9: 23, 10: 32, 11: 46}
# Words that are joined in one style; the last ones of a document go with those before them.
STYLED_WORDS = 64
STYLES = 7
WORD = "[A-Za-z]{2,12}"
# Bits of a place in the longest alphabet.
PLANES = (len(BASE64) - 1).bit_length()
PRIOR_WORDS = (
    "account action address array batch before bucket buffer button cache change channel client column commit config "
    "content context control count create current customer data default delete deploy device document enable error "
    "event export factory field file filter first format group handler header history image import index input item "
    "job label layout length library limit line list listener load local manager message method model module number "
    "object offset option order output package page parent path plugin policy process product profile project "
    "property query reader record region report request resource response result river route row sample schema "
    "search second server service session setting shape simple source state status stream string summer system "
    "table target template thread time title type unique update user value vector version view visible water widget "
    "window worker year yellow zone").split()


def find(text: Column, pattern: str, kind: str, keep: Column | None = None) -> Column:
    """All leftmost non-overlapping matches, as array<struct<start, end, kind, found>>.

    The text is split at the matches; the lengths of the gaps and matches give the places.
    """
    def places(pair: Column) -> Column:
        gaps, hits = pair["gaps"], pair["hits"]
        start = F.struct(F.lit(0).alias("at"), F.array().cast(
            "array<struct<start:int,end:int,kind:string,found:string>>").alias("out"))

        def step(acc: Column, i: Column) -> Column:
            begin = acc["at"] + F.length(F.get(gaps, i))
            end = begin + F.length(F.get(hits, i))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
                begin.alias("start"), end.alias("end"), F.lit(kind).alias("kind"),
                F.get(hits, i).alias("found")))).alias("out"))

        none = F.array().cast("array<int>")
        numbers = F.when(F.size(hits) > 0, F.sequence(F.lit(0), F.size(hits) - 1)).otherwise(none)
        return F.aggregate(numbers, start, step, lambda acc: acc["out"])

    return let(F.struct(F.split(text, pattern).alias("gaps"),
                        F.regexp_extract_all(text, F.lit(pattern), 0).alias("hits")), places)


def base_spans(text: Column) -> Column:
    """The spans of the fixed patterns, by start and then kind; matches that are too short are dropped."""
    none = F.array().cast("array<struct<start:int,end:int,kind:string,found:string>>")
    plain = F.lower(text)
    worded = plain.contains("passw") | plain.contains("secret") | plain.contains("token") | plain.contains("api")
    assign = F.when(worded, F.filter(find(text, ASSIGN, "assign"), lambda s: F.length(
        F.regexp_extract(s["found"], ASSIGN, 1)) >= 6)).otherwise(none)
    access = F.when(text.contains("AKIA"), F.filter(find(text, ACCESS, "access"),
                                                    lambda s: F.length(s["found"]) >= 20)).otherwise(none)
    # Whole runs of the class, so shorter runs need no place of their own.
    hexes = F.when(text.rlike(r"[0-9a-f]{24}"), find(text, r"[0-9a-f]{24,}", "hex")).otherwise(none)
    return F.concat(assign, access, hexes)


def normal_tail(z: Column) -> Column:
    """P(Z > z) by the logistic form; the error is below 2e-4 in the middle and the tails stay ordered."""
    cubic = F.greatest(F.lit(-80.0), F.least(F.lit(80.0), z * 1.5976 + F.pow(z, 3) * 0.07056))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(cubic))


def chi_score(x: Column, freedom: Column) -> Column:
    """The normal score with the tail of P(chi-squared > x), by the cube-root form."""
    spread = F.lit(2.0) / (freedom * 9.0)
    return (F.pow(x / freedom, 1.0 / 3.0) - (F.lit(1.0) - spread)) / F.sqrt(spread)


def alphabet(token: Column) -> Column:
    """The number of the smallest alphabet that holds all characters of a token."""
    return (F.when(token.rlike("^[0-9a-f]+$"), 0).when(token.rlike("^[0-9A-F]+$"), 1)
            .when(token.rlike("^[A-Z2-7]+$"), 2).when(token.rlike("^[a-z0-9]+$"), 3)
            .when(token.rlike("^[A-Za-z0-9]+$"), 4).otherwise(5))


def _class_sizes() -> Column:
    """For each alphabet the number of its characters in each class."""
    return F.array(*[F.array(*[F.lit(float(sum(ch in held for ch in letters))) for held in CLASSES.values()])
                     for letters in ALPHABETS])


def scores(s: Column | dict[str, Column]) -> dict[str, Column]:
    """The tests of the battery as normal scores, from its sums and counts; ``one_half`` stands for equal halves only."""
    n, size, high, sums = s["n"], s["size"], s["high"], s["sums"]
    tiny = F.lit(1e-9)
    product = high * (n - high) * 2
    variance = F.greatest(product * (product - n) / (n * n * (n - 1)), tiny)
    # Sums around the mean, from the plain ones.
    mean = sums["sum"] / n
    own = sums["squares"] - mean * sums["sum"]
    cross = sums["cross"] - mean * (sums["sum"] * 2 - s["first"] - sums["last"]) + mean * mean * (n - 1)
    return {
        "n": n, "even": chi_score(F.greatest(s["squares"] * size / n - n, tiny), size - 1),
        "classes": chi_score(F.greatest(s["classes"] * size / n - n, tiny), s["held"] - 1),
        "runs": F.abs(s["runs"] - product / n - 1) / F.sqrt(variance), "one_half": (high == 0) | (high == n),
        "serial": F.abs(F.when(own <= tiny, F.lit(1.0)).otherwise(cross / own)) * F.sqrt(n)}


def combined_score(z: Column | dict[str, Column]) -> Column:
    """The scores of the battery as one normal score (Fisher)."""
    runs = F.when(z["one_half"], F.pow(F.lit(2.0), -z["n"] + 1)).otherwise(normal_tail(z["runs"]) * 2)
    logs = [F.log(F.greatest(p, F.lit(P_FLOOR))) for p in (
        normal_tail(z["even"]), normal_tail(z["classes"]), runs, normal_tail(z["serial"]) * 2)]
    return chi_score(F.greatest(sum(logs, F.lit(0.0)) * -2.0, F.lit(1e-9)), F.lit(8.0))


def combined_value(score: Column) -> Column:
    """The p-value of the battery."""
    return F.greatest(normal_tail(score), F.lit(P_FLOOR))


def named(values: dict[str, Column]) -> list[Column]:
    return [value.alias(name) for name, value in values.items()]


def randomness(token: Column) -> Column:
    """Combined p-value of the battery; small for strings that are not evenly random.

    Counts that string functions can take are taken by them, the sums by one pass over the characters; the formulas
    then work on a struct of numbers, each computed once.
    """
    def with_alphabet(body: Column) -> Column:
        return let(alphabet(body), lambda number: let(F.struct(
            body.alias("body"), number.alias("number"),
            F.get(F.array(*[F.lit(a) for a in ALPHABETS]), number).alias("letters")), with_places))

    def with_places(s: Column) -> Column:
        size = F.length(s["letters"])
        halves = F.concat(F.repeat(F.lit("0"), F.floor(size / 2).cast("int")),
                          F.repeat(F.lit("1"), F.floor(size / 2).cast("int")))
        places = F.transform(F.split(s["body"], ""), lambda ch: F.position(ch, s["letters"]) - 1)
        return let(F.struct(
            size.cast("double").alias("size"), F.filter(places, lambda v: v >= 0).alias("x"),
            F.call_function("translate", s["body"], s["letters"], halves).alias("halves"),
            F.translate(s["body"], CLASS_FROM, CLASS_TO).alias("classes"),
            F.get(_class_sizes(), s["number"]).alias("of")), with_counts)

    def with_counts(s: Column) -> Column:
        def times(text: Column, mark: str) -> Column:
            return ((F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))) / len(mark)).cast("double")

        zero = F.lit(0).cast("long")
        # Equal characters lie side by side: the k-th of a kind adds 2k - 1 to the sum of the squared counts.
        squares = F.aggregate(
            F.array_sort(s["x"]), F.struct(F.lit(-1).alias("last"), zero.alias("k"), zero.alias("sum")),
            lambda acc, v: let(F.when(acc["last"] == v, acc["k"] + 1).otherwise(F.lit(1).cast("long")), lambda k: F.struct(
                v.alias("last"), k.alias("k"), (acc["sum"] + k * 2 - 1).alias("sum"))), lambda acc: acc["sum"])
        sums = F.aggregate(
            s["x"], F.struct(zero.alias("last"), zero.alias("sum"), zero.alias("squares"), zero.alias("cross")),
            lambda acc, v: F.struct(
                v.cast("long").alias("last"), (acc["sum"] + v).alias("sum"), (acc["squares"] + v * v).alias("squares"),
                (acc["cross"] + acc["last"] * v).alias("cross")))
        by_class = [F.when(F.get(s["of"], F.lit(i)) > 0, F.pow(times(s["classes"], mark), 2.0) / F.get(s["of"], F.lit(i)))
                    .otherwise(0.0) for i, mark in enumerate(CLASSES)]
        return let(F.struct(
            s["size"].alias("size"), F.size(s["x"]).cast("double").alias("n"), squares.cast("double").alias("squares"),
            times(s["halves"], "1").alias("high"), (times(s["halves"], "01") + times(s["halves"], "10") + 1).alias("runs"),
            sum(by_class, F.lit(0.0)).alias("classes"), F.size(F.filter(s["of"], lambda v: v > 0)).alias("held"),
            F.get(s["x"], F.lit(0)).cast("double").alias("first"), sums.alias("sums")), valued)

    def valued(counts: Column) -> Column:
        found = let(F.struct(*named(scores(counts))), lambda z: let(combined_score(z), combined_value))
        return F.when(counts["n"] < MIN_RANDOM, F.lit(0.0)).otherwise(found)


    # The padding at the end of base 64 says nothing.
    return let(F.regexp_replace(token, "=+", ""), with_alphabet)


def length_class(token: Column) -> Column:
    """Classes of lengths by powers of the square root of two."""
    return F.floor(F.log2(F.length(token).cast("double")) * 2).cast("int")


def grid_cell(p: Column) -> Column:
    """0 for the smallest p-values, GRID - 1 for those near 1."""
    scale = (GRID - 1) / -math.log(P_FLOOR)
    return F.greatest(F.lit(0), F.lit(GRID - 1) + F.ceil(F.log(F.greatest(p, F.lit(P_FLOOR))) * scale).cast("int"))


def _candidates(text: Column, base: Column) -> Column:
    """Candidate spans outside the base spans, with p, length class and grid cell.

    Base spans are cut out of a run; the pieces between them are candidates of their own.
    """
    def pieces(s: Column) -> Column:
        cuts = F.filter(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))

        def between(cut: Column) -> Column:
            starts = F.array_distinct(F.concat(F.array(s["start"]), F.transform(cut, lambda b: b["end"])))
            free = F.filter(starts, lambda p: (p < s["end"]) & ~F.exists(
                cut, lambda b: (b["start"] <= p) & (p < b["end"])))

            def piece(p: Column) -> Column:
                end = F.least(s["end"], F.array_min(F.transform(F.filter(
                    cut, lambda b: b["start"] > p), lambda b: b["start"])))
                return F.struct(p.alias("start"), end.alias("end"), s["kind"].alias("kind"),
                                F.substr(s["found"], p - s["start"] + 1, end - p).alias("found"))

            return F.transform(free, piece)

        return let(cuts, between)

    runs = F.filter(F.flatten(F.transform(find(text, TOKEN, "random"), pieces)), lambda s: (
        F.length(s["found"]) >= MIN_RANDOM) & s["found"].rlike("[0-9]") & s["found"].rlike("[A-Za-z]"))
    found = F.transform(runs, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"),
        randomness(s["found"]).alias("p"), length_class(s["found"]).alias("cls")))
    none = F.array().cast("array<struct<start:int,end:int,kind:string,p:double,cls:int>>")
    return F.when(text.rlike(TOKEN), found).otherwise(none)


def readable_runs(texts: DataFrame) -> DataFrame:
    """Column ``run``: all words of the column ``text``, joined the way names are and cut into runs of the reference lengths.

    Every ``STYLED_WORDS`` words take the next of ``STYLES`` styles, beginning where the hash of the text says. What
    they give is cut end to end, the lengths in turn, a digit after each run; the last run ends with the words, so it
    may overlap the one before. Words that give less than the shortest run give none.
    """
    seed = F.pmod(F.xxhash64(F.lit("reference"), F.col("text")), F.lit(1 << 40))

    def groups(words: Column) -> Column:
        last = F.greatest(F.floor(F.size(words) / STYLED_WORDS).cast("int"), F.lit(1)) - 1
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(
            words, i * STYLED_WORDS + 1, F.when(i == last, F.size(words)).otherwise(STYLED_WORDS)), " "))

    found = texts.filter("text IS NOT NULL").select(
        seed.alias("seed"), let(F.regexp_extract_all("text", F.lit(WORD), 0), groups).alias("groups"))
    placed = found.select("seed", F.posexplode("groups").alias("at", "words")).select(
        (F.col("seed") + F.col("at")).alias("turn"), "words").withColumn("style", F.pmod("turn", F.lit(STYLES)))
    words, style = F.col("words"), F.col("style")

    def with_mark(text: Column, mark: str) -> Column:
        return F.replace(text, F.lit(" "), F.lit(mark))

    joined = placed.withColumn("name", F.when(style.isin(0, 6), with_mark(F.initcap(words), "")).when(
        style == 1, with_mark(F.lower(words), "_")).when(style == 2, with_mark(F.lower(words), "/")).when(
        style == 3, with_mark(F.lower(words), "-")).when(style == 4, with_mark(F.upper(words), "_")).otherwise(
        with_mark(F.lower(words), ""))).withColumn("long", F.length("name"))
    # The digit is added later.
    lengths = [n - 1 for n in REFERENCE_LENGTHS.values()]
    kinds, cycle = len(lengths), sum(lengths)
    fits = sum((F.when(F.col("long") >= n, 1).otherwise(0) for n in lengths[1:]), F.lit(0))
    first = F.least(F.pmod(F.floor(F.col("turn") / STYLES), F.lit(kinds)).cast("int"), F.col("fits"))
    # Where the k-th run of a cycle begins that starts with a given length.
    begins = [[sum(lengths[(r + i) % kinds] for i in range(k)) for k in range(kinds)] for r in range(kinds)]
    begin = F.array(*[F.lit(n) for row in begins for n in row])
    rest = F.col("long") % cycle
    runs = F.floor(F.col("long") / cycle).cast("int") * kinds + sum(
        (F.when(rest > F.get(begin, F.col("first") * kinds + k), 1).otherwise(0) for k in range(kinds)), F.lit(0))
    cut = joined.filter(F.col("long") >= lengths[0]).withColumn("fits", fits).withColumn("first", first).select(
        "name", "long", "turn", "style", "first", "fits", F.explode(F.sequence(F.lit(0), runs - 1)).alias("k"))
    length = F.get(F.array(*[F.lit(n) for n in lengths]), F.least((F.col("first") + F.col("k")) % kinds, F.col("fits")))
    start = F.floor(F.col("k") / kinds).cast("int") * cycle + F.get(begin, F.col("first") * kinds + F.col("k") % kinds)
    piece = F.substr("name", F.least(F.col("start"), F.col("long") - F.col("length")) + 1, F.col("length"))
    pieces = cut.withColumns({"length": length, "start": start}).select(
        (F.col("turn") + F.col("k")).alias("turn"), "style", piece.alias("piece"))
    # Names of the last style begin with a small letter.
    begun = F.when(style == 6, F.concat(F.lower(F.substr("piece", F.lit(1), F.lit(1))), F.substr("piece", F.lit(2)))
                   ).otherwise(F.col("piece"))
    return pieces.select(F.concat(begun, (F.col("turn") % 10).cast("string")).alias("run"))


def run_values(runs: DataFrame) -> DataFrame:
    """(cls, p) of the column ``run``: what ``randomness`` gives, for tokens of 20 to 62 characters without padding.

    Each bit of the places of all characters of a run makes one whole number, so the sums and counts of the battery
    are counts of bits.
    """
    run, canon, n = F.col("run"), F.col("canon"), F.col("n")
    one = F.lit(1).cast("long")

    def by_alphabet(value: Callable[[str], Column]) -> Column:
        chosen = F.when(F.col("number") == 0, value(ALPHABETS[0]))
        for i, letters in enumerate(ALPHABETS[1:-1], 1):
            chosen = chosen.when(F.col("number") == i, value(letters))
        return chosen.otherwise(value(ALPHABETS[-1]))

    def bits(marks: str) -> Column:
        """The characters of ``canon`` as a binary number, by the mark of each place."""
        return F.coalesce(F.conv(F.translate(canon, BASE64, marks), 2, 10).cast("long"), F.lit(0).cast("long"))

    def upper_half(letters: str) -> Column:
        return bits("0" * (len(letters) // 2) + "1" * (len(BASE64) - len(letters) // 2))

    def place(at: Column) -> Column:
        return (F.position(F.substr(canon, at, F.lit(1)), F.lit(BASE64)) - 1).cast("double")

    def apart(value: Column) -> Column:
        """The value itself, by a lambda: Spark then compiles the step in small methods of its own. All steps in one
        method are more than the JVM compiles, and take twice the time."""
        return let(value, lambda v: v)

    def ones(value: Column) -> Column:
        return F.bit_count(value).cast("double")

    def total(values: list[Column]) -> Column:
        return sum(values[1:], values[0])

    # Each character becomes that of the longest alphabet at the same place.
    same = runs.select("run", alphabet(run).alias("number")).withColumn("canon", by_alphabet(
        lambda letters: run if BASE64.startswith(letters) else F.translate(run, letters, BASE64[:len(letters)])))
    places = range(len(BASE64))
    planes = {f"b{i}": bits("".join(str(k >> i & 1) for k in places)) for i in range(PLANES)}
    lengths = F.length("run")
    numbered = same.select(
        "run", "number", apart(lengths).alias("n"), by_alphabet(upper_half).alias("half"), place(F.lit(1)).alias("first"),
        place(lengths).alias("last"), F.translate(run, CLASS_FROM, CLASS_TO).alias("classes"),
        (F.call_function("shiftleft", one, lengths) - 1).alias("all"), *[value.alias(name) for name, value in planes.items()])
    b = [F.col(name) for name in planes]

    def held(low: int, high: int, value: int) -> Column:
        """The characters whose bits from ``low`` to ``high`` are ``value``."""
        found = F.col("all")
        for i in range(low, high):
            found = found.bitwiseAND(b[i] if value >> (i - low) & 1 else F.bitwise_not(b[i]))
        return found

    middle = PLANES // 2
    lower = {f"l{v}": held(0, middle, v) for v in range(1 << middle)}
    upper = {f"u{v}": held(middle, PLANES, v) for v in range((places[-1] >> middle) + 1)}
    masked = numbered.withColumns({"n": apart(n)} | lower | upper)
    counts = {f"c{k}": ones(F.col(f"u{k >> middle}").bitwiseAND(F.col(f"l{k % (1 << middle)}"))) for k in places}
    changes = F.col("half").bitwiseXOR(F.shiftright("half", 1)).bitwiseAND(F.shiftright("all", 1))

    def classes(letters: str) -> Column:
        sizes = {mark: sum(ch in of for ch in letters) for mark, of in CLASSES.items()}
        return total([F.pow((F.length("classes") - F.length(F.replace(F.col("classes"), F.lit(mark), F.lit("")))).cast(
            "double"), 2.0) / float(size) for mark, size in sizes.items() if size])

    summed = masked.withColumns({"n": apart(n)} | counts).select(
        "run", apart(n.cast("double")).alias("n"), by_alphabet(lambda a: F.lit(float(len(a)))).alias("size"),
        total([F.col(x) * F.col(x) for x in counts]).alias("squares"), ones(F.col("half")).alias("high"),
        (ones(changes) + 1).alias("runs"), by_alphabet(classes).alias("classes"),
        by_alphabet(lambda a: F.lit(sum(any(ch in of for ch in a) for of in CLASSES.values()))).alias("held"),
        "first", "last", total([ones(x) * float(1 << i) for i, x in enumerate(b)]).alias("sum"),
        total([ones(x.bitwiseAND(y)) * float((1 if i == k else 2) << i + k)
               for i, x in enumerate(b) for k, y in enumerate(b) if i <= k]).alias("x_squares"),
        total([ones(x.bitwiseAND(F.shiftright(y, 1))) * float(1 << i + k)
               for i, x in enumerate(b) for k, y in enumerate(b)]).alias("cross"))
    parts = {name: F.col(name) for name in ("n", "size", "squares", "high", "runs", "classes", "held", "first")}
    sums = {"sum": F.col("sum"), "squares": F.col("x_squares"), "cross": F.col("cross"), "last": F.col("last")}
    scored = summed.select(apart(length_class(run)).alias("cls"), *named(scores(parts | {"sums": sums})))
    joint = scored.select(apart(F.col("cls")).alias("cls"), combined_score({
        name: F.col(name) for name in scored.columns}).alias("score"))
    return joint.select("cls", combined_value(F.col("score")).alias("p"))


def prior(spark: SparkSession, texts: int = PRIOR_TEXTS) -> DataFrame:
    """Texts of common words, in the column ``text``."""
    known = F.array(*[F.lit(w) for w in PRIOR_WORDS])
    words = F.transform(F.sequence(F.lit(1), F.lit(20)), lambda i: F.get(
        known, F.pmod(F.xxhash64(F.lit("prior"), F.col("id"), i), F.lit(len(PRIOR_WORDS))).cast("int")))
    return spark.range(texts).select(F.array_join(words, " ").alias("text"))


def reference(texts: DataFrame) -> DataFrame:
    """How many readable runs (``n``) of all the texts and of common words lie in each class and grid cell."""
    runs = readable_runs(texts.select("text").unionByName(prior(texts.sparkSession)))
    return run_values(runs).select("cls", grid_cell(F.col("p")).alias("cell")).groupBy("cls", "cell").agg(
        F.count(F.lit(1)).alias("n"))


def readable_share(counts: dict[int, int]) -> Callable[[int], float]:
    """The fitted probability that a readable run lies in a grid cell or a more random one."""
    width = -math.log10(P_FLOOR) / (GRID - 1)
    total = sum(counts.values())

    def quantile(share: float) -> float:
        """The share-quantile of log(-log10 p), from the random end; linear within a cell."""
        seen, wanted = 0, share * total
        for cell in sorted(counts, reverse=True):
            if seen + counts[cell] >= wanted:
                return math.log(max((GRID - 1 - cell + (wanted - seen) / counts[cell]) * width, width / 2))
            seen += counts[cell]
        return math.log(-math.log10(P_FLOOR))

    middle = quantile(0.5)
    spread = max((middle - quantile(0.1)) / 1.2816, 1e-3)
    return lambda cell: 0.5 * math.erfc((middle - math.log((GRID - cell) * width)) / spread / math.sqrt(2.0))


def thresholds(candidates: DataFrame, references: DataFrame, false_share: float = FALSE_SHARE) -> dict[int, int]:
    """For each length class of the candidates, the first grid cell that is reported (GRID for none).

    Candidates have cls and cell, references cls, cell and their count n. Only the cell counts come to the driver:
    GRID rows a class at most.
    """
    asked = candidates.groupBy("cls", "cell").agg(F.count(F.lit(1)).alias("n"))
    sides = asked.withColumn("asked", F.lit(True)).unionByName(references.withColumn("asked", F.lit(False)))
    counts: dict[bool, dict[int, dict[int, int]]] = {True: {}, False: {}}
    for row in sides.collect():
        counts[row["asked"]].setdefault(row["cls"], {})[row["cell"]] = row["n"]
    shares = {cls: readable_share(cells) for cls, cells in counts[False].items()}
    limits = {}
    for cls, cells in counts[True].items():
        share = shares[max(min(shares), min(cls, max(shares)))]
        total, seen, limit = sum(cells.values()), 0, GRID
        for cell in sorted(cells, reverse=True):
            seen += cells[cell]
            if share(cell) <= false_share * seen / total:
                limit = cell
        limits[cls] = limit
    return limits


def scan(docs: DataFrame, text: str = "text", false_share: float = FALSE_SHARE, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (start, end, kind), by start and then kind.

    The rows are written once with all candidates; without ``keep_text`` the text is left out of what is written. The
    readable runs are read from the texts a second time.
    """
    taken = ["base", "spans", "__c"] + ([] if keep_text else [text])
    kept = others(docs, taken)
    staged = docs.select(*kept, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__c"))
    with_base = staged.withColumn("base", let(F.col("__c"), base_spans))
    found = with_base.withColumn("spans", _candidates(F.col("__c"), F.col("base"))).drop("__c")
    placed = settle(found.withColumn("base", F.transform("base", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))), "scanned").frame
    texts = (placed if keep_text else docs).select(F.col(f"`{text}`").alias("text"))
    flat = placed.select(F.explode("spans").alias("s")).select("s.cls", grid_cell(F.col("s.p")).alias("cell"))
    limits = thresholds(flat, reference(texts), false_share)
    rule = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair]) if limits else None

    def is_random(s: Column) -> Column:
        return grid_cell(s["p"]) >= rule[s["cls"]] if rule is not None else F.lit(False)

    added = F.transform(F.filter("spans", is_random), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return placed.withColumn("spans", in_order(F.concat("base", added))).withColumn("base", in_order(F.col("base")))


def in_order(spans: Column) -> Column:
    """Sort by start, then by kind as listed."""
    number = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), number[s["kind"]].alias("k"),
                                                  s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.sort_array(keyed), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(scanned: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Replace every span by ``mark``; overlapping spans are replaced as one. Drops ``base`` and ``spans``."""
    plain = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substr(plain, acc["at"] + 1, s["start"] - acc["at"])
        return F.when(s["end"] <= acc["at"], acc).when(s["start"] < acc["at"], F.struct(
            s["end"].alias("at"), acc["out"].alias("out"))).otherwise(F.struct(
                s["end"].alias("at"), F.concat(acc["out"], gap, F.lit(mark)).alias("out")))

    cleaned = F.aggregate(F.col("spans"), start, step,
                          lambda acc: F.concat(acc["out"], F.substr(plain, acc["at"] + 1)))
    changed = F.when(F.size("spans") > 0, cleaned).otherwise(F.col(f"`{text}`"))
    return scanned.withColumn(text, changed).drop("base", "spans")
