"""Secrets in texts, with column functions only: fixed patterns and a randomness test battery.

Every run of 20 or more characters of common encodings is a candidate. Its encoding is inferred
from the characters it has, and three statistics ask whether it could be uniform random in that
alphabet:

* chi-squared of the character counts,
* runs above and below the middle of the alphabet,
* serial correlation of neighbouring characters.

Each gives a tail probability (normal approximation), and Fisher's rule joins the three. Random
strings have a joint probability that is uniform on 0 to 1, other strings crowd near 0. So in each
stratum of encoding and length the strings above one half tell how many random strings there are
in all, and from that the share of false ones beyond any limit. The lowest limit that keeps this
share within ``FALSE_SHARE`` is the stratum's own: short strings, on which the tests have little
power, need a higher one. The counts run over all candidates of all documents.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertag.llm.storage import stage

# The base patterns, in the order in which kinds are listed.
ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a run that is shorter fails whole, so the length may stand here
HEX = r"[0-9a-f]{24,}"
FAR = 2**31 - 1
KINDS = ("assign", "access", "hex", "random")
ASSIGN_WORDS = ("passw", "secret", "token", "api")
MIN_VALUE = 6

RUN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
FALSE_SHARE = 0.1
STEPS = 200
# In a stratum with fewer candidates the shares are chance. There a fixed limit holds: identifiers of two or
# three words reach some hundredths in fewer than 32 characters, and a thousandth in more.
FEW = 50
FEW_LIMITS = {4: 0.1}  # by the binary logarithm of the length
FEW_LIMIT = 0.005
BLOCK = 64
CHUNK = 4096  # code points that a text is cut into before pieces are taken out of it
MARK = "[SECRET]"
OWN = "_secret_scan_"  # columns on the way to the redacted text

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# Name, which strings are taken to be in it, alphabet; the first that fits counts. An encoding asks
# for characters that words of one case don't mix.
ENCODINGS = (
    ("hex", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", DIGITS + "abcdef"),
    ("HEX", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("base32", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$", UPPER + "234567"),
    ("base36", r"^(?=.*[0-9])(?=.*[a-z])[a-z0-9]+$", DIGITS + LOWER),
    ("BASE36", r"^(?=.*[0-9])(?=.*[A-Z])[A-Z0-9]+$", DIGITS + UPPER),
    ("base62", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9]+$", DIGITS + UPPER + LOWER),
    ("letters", r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z]+$", UPPER + LOWER),
    ("base64", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_"),
    ("mixed", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_-]+$", UPPER + LOWER + DIGITS + "+/-_"),
)
# All but the last, which is for what can't be cut.
WHOLE = ENCODINGS[:-1]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Use a value several times, also inside lambdas, and compute it once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _blocks(values: Column) -> Column:
    """An array as an array of arrays of BLOCK entries."""
    last = F.greatest(F.ceil(F.size(values) / BLOCK).cast("int") - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(values, k * BLOCK + 1, BLOCK))


def _running(values: Column, join: Callable[[Column, Column], Column], least: Column) -> Column:
    """What ``join`` gives for all numbers up to each place, in a time that grows with their count.

    Appending copies an array, so that is done within blocks of a fixed size and with one number for each
    block; then the blocks are put together.
    """

    def fold(numbers: Column) -> Column:
        def further(done: Column, x: Column) -> Column:
            now = join(done["now"], x)
            return F.struct(now.alias("now"), F.array_append(done["all"], now).alias("all"))

        none = F.array().cast("array<int>")
        return F.aggregate(numbers, F.struct(least.alias("now"), none.alias("all")), further, lambda d: d["all"])

    def together(inner: Column) -> Column:
        ends = F.transform(inner, lambda block: F.coalesce(F.try_element_at(block, F.lit(-1)), least))
        before = F.slice(F.concat(F.array(least), fold(ends)), 1, F.size(inner))
        return F.flatten(F.zip_with(inner, before, lambda block, x: F.transform(block, lambda y: join(x, y))))

    return _let(values, lambda numbers: _let(F.transform(_blocks(numbers), fold), together))


def _plus(a: Column, b: Column) -> Column:
    return a + b


def _located(text: Column, pattern: str, value_group: int = 0) -> Column:
    """Matches in order: ``start`` and ``end`` in code points, and ``value``, the wanted group.

    What the pattern splits off and what it matches take turns, so their lengths give the places.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    wanted = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    # There is one gap more than there are matches; the last entry has no match and goes.
    parts = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), lambda gap: F.length(gap)).alias("gap"),
        F.transform(whole, lambda match: F.length(match)).alias("size"),
        (wanted if value_group else whole).alias("value"),
    )

    def placed(found: Column) -> Column:
        ends = _running(F.transform(found, lambda x: x["gap"] + x["size"]), _plus, F.lit(0))
        return F.zip_with(
            found,
            ends,
            lambda x, end: F.struct((end - x["size"]).alias("start"), end.alias("end"), x["value"].alias("value")),
        )

    return _let(F.filter(parts, lambda x: x["size"].isNotNull()), placed)


def _none() -> Column:
    return F.array().cast("array<struct<start:int,end:int,value:string>>")


def _base(text: Column) -> dict[str, Column]:
    """Spans of each kind. The cheap tests before the patterns never turn a match away."""
    lowered = F.lower(text)
    has_word = F.lit(False)
    for word in ASSIGN_WORDS:
        has_word = has_word | F.contains(lowered, F.lit(word))
    assign = F.filter(_located(text, ASSIGN, 2), lambda x: F.length(x["value"]) >= MIN_VALUE)
    return {
        "assign": F.when(has_word, assign).otherwise(_none()),
        "access": F.when(F.contains(text, F.lit("AKIA")), _located(text, ACCESS)).otherwise(_none()),
        "hex": F.when(text.rlike(HEX), _located(text, HEX)).otherwise(_none()),
    }


def _tail(z: Column) -> Column:
    """Probability of a normal value over z (a logistic form, within 0.0002)."""
    return F.greatest(1 / (1 + F.exp(1.5976 * z + 0.070566 * z * z * z)), F.lit(1e-12))


def _fits(value: Column) -> Column:
    fits = F.lit(False)
    for _, pattern, _ in WHOLE:
        fits = fits | value.rlike(pattern)
    return fits


def _runs(text: Column) -> Column:
    """Runs of characters of common encodings, without padding, as long as they are found."""

    def bare(x: Column) -> Column:
        value = F.rtrim(x["value"], F.lit("="))
        return F.struct(x["start"].alias("start"), (x["start"] + F.length(value)).alias("end"), value.alias("value"))

    return F.when(text.rlike(RUN), F.transform(_located(text, RUN), bare)).otherwise(_none())


def _cut(runs: Column, characters: str) -> Column:
    """Runs that are in no encoding give way to their long parts of these characters, if those are in one.

    Every run becomes an array of itself or its parts.
    """

    def parts(x: Column) -> Column:
        pattern = f"[{characters}]{{20,}}"
        found = F.regexp_extract_all(x["value"], F.lit(pattern), F.lit(0))
        pairs = F.arrays_zip(F.split(x["value"], pattern, -1).alias("gap"), found.alias("value"))
        none = F.array().cast("array<struct<start:int,end:int,value:string>>")

        def further(done: Column, part: Column) -> Column:
            start = done["at"] + F.length(part["gap"])
            end = start + F.length(part["value"])
            span = F.struct(start.alias("start"), end.alias("end"), part["value"].alias("value"))
            return F.struct(end.alias("at"), F.array_append(done["found"], span).alias("found"))

        first = F.struct(x["start"].alias("at"), none.alias("found"))
        whole = F.filter(pairs, lambda y: y["value"].isNotNull())
        return F.filter(F.aggregate(whole, first, further, lambda d: d["found"]), lambda y: _fits(y["value"]))

    def chosen(x: Column) -> Column:
        return F.when(_fits(x["value"]), F.array(x)).otherwise(parts(x))

    cut = F.transform(runs, lambda x: F.struct(x.alias("run"), chosen(x).alias("parts")))
    return F.flatten(
        F.transform(cut, lambda x: F.when(F.size(x["parts"]) > 0, x["parts"]).otherwise(F.array(x["run"])))
    )


def _encoded(candidates: Column) -> Column:
    """Candidates of an encoding that can be tested: with its name and its size, and the characters
    as numbers below that size."""

    def infer(x: Column) -> Column:
        chosen = F.lit(None).cast("struct<name:string,letters:string>")
        for name, pattern, letters in reversed(ENCODINGS):
            entry = F.struct(F.lit(name).alias("name"), F.lit(letters).alias("letters"))
            chosen = F.when(x["value"].rlike(pattern), entry).otherwise(chosen)
        return F.struct(
            x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"), chosen.alias("encoding")
        )

    def number(x: Column) -> Column:
        letters = x["encoding"]["letters"]
        characters = F.filter(F.split(x["value"], "", -1), lambda c: c != "")
        codes = F.transform(
            characters, lambda c: F.call_function("instr", letters, c).cast("double") - 1
        )
        band = F.floor(F.log2(F.length(x["value"]))).cast("string")
        return F.struct(
            x["start"].alias("start"),
            x["end"].alias("end"),
            F.concat_ws(":", x["encoding"]["name"], band).alias("stratum"),
            F.length(letters).cast("double").alias("size"),
            codes.alias("codes"),
        )

    known = F.filter(F.transform(candidates, infer), lambda x: x["encoding"].isNotNull())
    return F.transform(known, number)


def _measured(encoded: Column) -> Column:
    """The three statistics of each candidate."""

    def measure(x: Column) -> Column:
        codes, middle = x["codes"], (x["size"] - 1) / 2
        counts = F.transform(
            F.array_distinct(codes), lambda c: F.size(F.filter(codes, lambda y: y == c)).cast("double")
        )
        pairs = F.zip_with(
            F.slice(codes, 1, F.size(codes) - 1),
            F.slice(codes, 2, F.size(codes) - 1),
            lambda a, b: F.struct((a - middle).alias("a"), (b - middle).alias("b")),
        )
        sums = F.aggregate(
            pairs,
            F.struct(F.lit(0.0).alias("turns"), F.lit(0.0).alias("products")),
            lambda done, p: F.struct(
                (done["turns"] + ((p["a"] > 0) != (p["b"] > 0)).cast("double")).alias("turns"),
                (done["products"] + p["a"] * p["b"]).alias("products"),
            ),
        )
        return F.struct(
            x["start"].alias("start"),
            x["end"].alias("end"),
            x["stratum"].alias("stratum"),
            x["size"].alias("size"),
            F.size(codes).cast("double").alias("n"),
            F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * c).alias("squares"),
            sums.alias("sums"),
        )

    return F.transform(encoded, measure)


def _tested(measured: Column) -> Column:
    """Candidates with the joint tail probability of the three tests, if they were uniform."""

    def logs(x: Column) -> Column:
        n, size = x["n"], x["size"]
        chi = size / n * x["squares"] - n
        uniformity = (chi - (size - 1)) / F.sqrt(2 * (size - 1) * (n - 1) / n)
        runs = F.abs(x["sums"]["turns"] - (n - 1) / 2) / F.sqrt((n - 1) / 4)
        serial = F.abs(x["sums"]["products"]) / (F.sqrt(n - 1) * (size * size - 1) / 12)
        total = F.log(_tail(uniformity)) + F.log(2 * _tail(runs)) + F.log(2 * _tail(serial))
        return F.struct(
            x["start"].alias("start"),
            x["end"].alias("end"),
            x["stratum"].alias("stratum"),
            F.greatest(-total, F.lit(0.0)).alias("half"),
        )

    def joint(x: Column) -> Column:
        half = x["half"]
        return F.struct(
            x["start"].alias("start"),
            x["end"].alias("end"),
            x["stratum"].alias("stratum"),
            (F.exp(-half) * (1 + half + half * half / 2)).alias("p"),
        )

    return F.transform(F.transform(measured, logs), joint)


def _text(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def _scanned(docs: DataFrame) -> DataFrame:
    """Base spans by kind and tested candidates, in columns whose names begin with OWN.

    Each step is a column of its own, so that none is computed twice and no expression grows too deep. A
    run that is in no encoding as a whole, like a path with a key at its end, is cut at the characters that
    not all encodings have: at all four of them, or where no long part is left then, at one pair, so
    that a part may be in the encoding that has the other pair.
    """
    text = _text(docs)
    steps = docs.withColumns({f"{OWN}{kind}": found for kind, found in _base(text).items()})
    at = f"{OWN}candidates"
    steps = steps.withColumn(at, _runs(text))
    for characters in ("A-Za-z0-9", "A-Za-z0-9+/", "A-Za-z0-9_-"):
        steps = steps.withColumn(at, _cut(F.col(at), characters))
    for step in (_encoded, _measured, _tested):
        steps = steps.withColumn(at, step(F.col(at)))
    return steps


def limits(candidates: DataFrame, false_share: float = FALSE_SHARE) -> dict[str, float]:
    """The lowest probability that counts as random, by stratum, from an array column ``candidates``.

    In a stratum with fewer than FEW candidates a fixed limit for its length holds; in one whose false share never falls to
    the wanted one, nothing counts as random.

    The table behind it has a row for each stratum and step, a number that the data don't change.
    """
    one = candidates.select(F.explode("candidates").alias("c"))
    step = F.least(F.floor(F.col("c.p") * STEPS), F.lit(STEPS - 1)).cast("int")
    counts = one.groupBy(F.col("c.stratum").alias("stratum"), step.alias("step")).count()
    strata: dict[str, dict[int, int]] = {}
    for stratum, at, count in counts.toLocalIterator():
        strata.setdefault(stratum, {})[at] = count
    found = {}
    for stratum, steps in strata.items():
        if sum(steps.values()) < FEW:
            found[stratum] = FEW_LIMITS.get(int(stratum.rpartition(":")[2]), FEW_LIMIT)
            continue
        half = sum(n for at, n in steps.items() if at >= STEPS // 2)
        random = 2 * (half + math.sqrt(half))  # as many as there may well be
        for at in range(1, STEPS // 2 + 1):
            passed = sum(n for k, n in steps.items() if k >= at)
            false = passed - random * (1 - at / STEPS)
            if passed and false <= false_share * passed:
                found[stratum] = at / STEPS
                break
    return found


def _of(kind: str, found: Column) -> Column:
    number = F.lit(KINDS.index(kind))
    return F.transform(
        found,
        lambda x: F.struct(x["start"].alias("start"), number.alias("kind"), x["end"].alias("end")),
    )


def _fixed(base: dict[str, Column]) -> Column:
    """All base spans by start and kind."""
    return F.array_sort(F.concat(*(_of(name, base[name]) for name in KINDS[:3])))


def _spans(fixed: Column, candidates: Column, chosen: dict[str, float]) -> Column:
    """The base spans and the random strings that don't touch them."""
    if not chosen:
        return fixed
    limit = F.create_map(*(F.lit(v) for pair in sorted(chosen.items()) for v in pair))
    high = F.filter(candidates, lambda x: x["p"] >= F.try_element_at(limit, x["stratum"]))
    number = F.lit(KINDS.index("random"))
    tagged = F.array_sort(F.concat(fixed, _of("random", high)))

    def untouched(spans: Column) -> Column:
        # In the order of starts: how far the base spans before reach, and where the next one starts.
        own = F.transform(spans, lambda x: x["kind"] == number)
        reach = F.transform(spans, lambda x: F.when(x["kind"] == number, F.lit(-1)).otherwise(x["end"]))
        starts = F.transform(
            F.reverse(spans), lambda x: F.when(x["kind"] == number, F.lit(FAR)).otherwise(x["start"])
        )
        before = _running(reach, F.greatest, F.lit(-1))
        after = F.reverse(_running(starts, F.least, F.lit(FAR)))
        return F.filter(
            F.arrays_zip(spans.alias("span"), own.alias("own"), before.alias("before"), after.alias("after")),
            lambda x: ~x["own"] | ((x["before"] <= x["span"]["start"]) & (x["after"] >= x["span"]["end"])),
        )["span"]

    return F.when(F.size(high) == 0, fixed).otherwise(_let(tagged, untouched))


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda x: F.concat_ws(
                ":",
                F.element_at(names, x["kind"] + 1),
                x["start"].cast("string"),
                x["end"].cast("string"),
            ),
        ),
        ",",
    )


def scan(docs: DataFrame, false_share: float = FALSE_SHARE) -> DataFrame:
    """Secrets of each row: ``doc_id``, ``assign``, ``access``, ``hex`` (arrays of start, end, value),
    ``base`` and ``spans`` (arrays of start, kind number, end) and both as text.

    Places are code points, ends exclusive. Spans of the tests that touch a base span are left out.
    Null text counts as empty and has no secrets. Equal rows get equal results. An empty table gives
    no rows. Other columns of ``docs`` are left out.
    """
    names = [*KINDS[:3], "candidates"]
    scanned = _scanned(docs.select("doc_id", "text"))
    found = stage(scanned.select("doc_id", *(F.col(f"{OWN}{n}").alias(n) for n in names)), "secrets")
    chosen = limits(found, false_share)
    spread = found.withColumn("base", _fixed({n: F.col(n) for n in KINDS[:3]}))
    spread = spread.withColumn("spans", _spans(F.col("base"), F.col("candidates"), chosen))
    return spread.select(
        "doc_id",
        *KINDS[:3],
        "base",
        "spans",
        _listed(F.col("base")).alias("base_text"),
        _listed(F.col("spans")).alias("spans_text"),
    )


def _replaced(text: Column, spans: Column, mark: str) -> Column:
    """The text with a mark for each span; of spans that overlap, one mark stands for all.

    Taking a piece out of a text reads it from its beginning, so it is cut into chunks first.
    """

    def piece(chunks: Column, low: Column, high: Column) -> Column:
        def taken(k: Column) -> Column:
            first = F.greatest(low - k * CHUNK, F.lit(0))
            return F.substr(F.get(chunks, k), first + 1, F.least(high - k * CHUNK, F.lit(CHUNK)) - first)

        some = F.sequence(F.floor(low / CHUNK).cast("int"), F.floor((high - 1) / CHUNK).cast("int"))
        return F.when(high > low, F.array_join(F.transform(some, taken), "")).otherwise(F.lit(""))

    def marked(all_: Column) -> Column:
        chunks, spans, ends = all_["chunks"], all_["spans"], all_["ends"]
        before = F.slice(F.concat(F.array(F.lit(0)), ends), 1, F.size(spans))
        out = F.zip_with(
            spans,
            before,
            lambda x, at: F.when(
                x["start"] >= at, F.concat(piece(chunks, at, x["start"]), F.lit(mark))
            ).otherwise(F.lit("")),
        )
        rest = piece(chunks, F.element_at(ends, -1), F.length(text))
        return F.concat(F.array_join(out, ""), rest)

    ends = _running(F.transform(spans, lambda x: x["end"]), F.greatest, F.lit(0))
    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    return _let(F.struct(chunks.alias("chunks"), spans.alias("spans"), ends.alias("ends")), marked)


def redact(docs: DataFrame, mark: str = MARK, false_share: float = FALSE_SHARE) -> DataFrame:
    """``docs`` with every secret replaced by a mark; ``n_chars`` follows where it exists.

    Texts without secrets, null ones too, stay as they are, and so do all other columns.
    """
    scanned = _scanned(docs.select("text")).select(F.col(f"{OWN}candidates").alias("candidates"))
    candidates = stage(scanned, "candidates")
    chosen = limits(candidates, false_share)
    names = docs.columns
    steps = _scanned(docs)
    base = {name: F.col(f"{OWN}{name}") for name in KINDS[:3]}
    steps = steps.withColumn(f"{OWN}fixed", _fixed(base))
    steps = steps.withColumn(f"{OWN}spans", _spans(F.col(f"{OWN}fixed"), F.col(f"{OWN}candidates"), chosen))
    clean = _replaced(_text(docs), F.col(f"{OWN}spans"), mark)
    changed = docs["text"].isNotNull() & (F.size(f"{OWN}spans") > 0)
    out = steps.withColumn("text", F.when(changed, clean).otherwise(docs["text"]))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*names)
