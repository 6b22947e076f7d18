"""Personal data by rules and by bootstrapped context, with DataFrame functions only.

The rules' matches are seeds. Words beside them become lexical patterns; patterns and the identifiers they surround
form a graph whose scores are computed in rounds, and patterns that end up trusted mark identifiers no rule knows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import table, text_or_empty
from reviewlake.session import pin

KINDS = ("email", "ip", "card", "phone", "identifier")
# The rules as the contract words them, with quantifiers that never go back over what they took, so that long runs
# cost linear time and no stack. A run is entered at its head or where the previous match ended.
RULES = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A cheap look that says whether a rule can match at all.
GLANCES = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"

#: A word with a digit or an at sign, and what of it may name somebody.
TOKEN = r"(?<!\S)(?=\S*[0-9@])\S++"
CORE = r"^[^A-Za-z0-9+]*+(.*?)[^A-Za-z0-9]*$"
#: Matches whose positions are added up at a time.
BLOCK = 256
#: Code points of context looked at on either side of a token.
REACH = 64
#: Rounds of scoring; a pattern is trusted from this score on, when at least so many different seeds stand in it.
ROUNDS, TRUSTED, SEEDS = 3, 0.75, 3
#: A new identifier has at least so many characters and digits.
LONG, DIGITS = 8, 3


def _empty(kind: str) -> Column:
    return F.expr(f"CAST(array() AS array<{kind}>)")


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _places(text: Column, pattern: str) -> Column:
    """(start, end, found, left, right) of each match, in code points, with the text around it.

    Positions add up over the gaps between matches, in blocks, so that a text with very many matches costs no
    quadratic copying.
    """
    kind = "struct<start: int, end: int, found: string, left: string, right: string>"

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["gap"])
        end = start + F.length(part["found"])
        place = F.struct(
            start.alias("start"),
            end.alias("end"),
            part["found"].alias("found"),
            F.right(part["gap"], F.lit(REACH)).alias("left"),
            F.left(part["next"], F.lit(REACH)).alias("right"),
        )
        return F.struct(end.alias("at"), F.array_append(state["out"], place).alias("out"))

    def blocks(parts: Column) -> Column:
        def block(state: Column, b: Column) -> Column:
            first = F.struct(state["at"].alias("at"), _empty(kind).alias("out"))
            inner = F.aggregate(F.slice(parts, b * BLOCK + 1, F.lit(BLOCK)), first, step)
            return _let(inner, lambda x: F.struct(x["at"].alias("at"), F.array_append(state["out"], x["out"]).alias("out")))

        first = F.struct(F.lit(0).alias("at"), _empty(f"array<{kind}>").alias("out"))
        numbers = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / BLOCK).cast("int"))
        whole = F.aggregate(numbers, first, block, lambda state: F.flatten(state["out"]))
        return F.when(F.size(parts) > 0, whole).otherwise(_empty(kind))

    def zipped(gaps: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        rows = F.arrays_zip(
            F.slice(gaps, F.lit(1), F.size(gaps) - 1).alias("gap"),
            found.alias("found"),
            F.slice(gaps, F.lit(2), F.size(gaps)).alias("next"),
        )
        return _let(rows, blocks)

    return _let(F.split(text, pattern, -1), zipped)


def _luhn(digits: Column) -> Column:
    def value(i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + value(i)) % 10 == 0


def _holds(kind: str, found: Column) -> Column:
    if kind == "ip":
        return found.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def rule_spans(text: Column) -> Column:
    """array of (start, rank, end, kind) of what the rules find, sorted; rank is the kind's place in KINDS."""
    return F.sort_array(F.concat(*(_rule(text, rank, kind) for rank, kind in enumerate(RULES))))


def _rule(text: Column, rank: int, kind: str) -> Column:
    good = F.filter(_places(text, RULES[kind]), lambda p: _holds(kind, p["found"]))
    spans = F.transform(good, lambda p: _span(p["start"], p["end"], rank, kind))
    nothing = _empty("struct<start: int, rank: int, end: int, kind: string>")
    return F.when(text.rlike(GLANCES[kind]), spans).otherwise(nothing)


def _span(start: Column, end: Column, rank: int, kind: str) -> Column:
    return F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"))


def _tokens(text: Column) -> Column:
    """(start, end, core, left, right) of each token that could name somebody: its core, and the words beside it."""

    def token(p: Column) -> Column:
        core = F.regexp_extract(p["found"], CORE, 1)
        start = p["start"] + F.instr(p["found"], core) - 1
        word = F.lower(F.regexp_extract(p["left"], r"(\S+)\s*$", 1))
        after = F.lower(F.regexp_extract(p["right"], r"^\s*(\S+)", 1))
        return F.struct(
            start.alias("start"), (start + F.length(core)).alias("end"), core.alias("core"), word.alias("left"), after.alias("right")
        )

    kind = "struct<start: int, end: int, core: string, left: string, right: string>"
    found = F.transform(_places(text, TOKEN), token)
    return F.when(text.rlike("[0-9@]"), F.filter(found, lambda t: F.length(t["core"]) > 0)).otherwise(_empty(kind))


def _patterns(token: Column) -> Column:
    """The lexical patterns a token stands in: the word before it, the word after it."""
    before = F.concat(F.lit("before "), F.regexp_replace(token["left"], "[0-9]+", "0"))
    after = F.concat(F.lit("after "), F.regexp_replace(token["right"], "[0-9]+", "0"))
    return F.filter(F.array(before, after), lambda p: ~p.isin("before ", "after "))


def trusted_patterns(tokens: DataFrame) -> DataFrame:
    """`pattern` of those whose score reaches TRUSTED after ROUNDS over the pattern-instance graph.

    `tokens`: core, left, right, seed. An instance is a token's text. A pattern scores the mean of its instances'
    scores (one unseen instance added), an instance that a rule knows scores 1 and any other the mean of its
    patterns' scores. A pattern needs SEEDS different seeds to be trusted.
    """
    token = F.struct("core", "left", "right")
    stands = tokens.select(F.lower("core").alias("instance"), "seed", F.explode(_patterns(token)).alias("pattern"))
    edges = pin(stands.groupBy("pattern", "instance").agg(F.count("*").alias("n"), F.max(F.col("seed").cast("int")).alias("seed")))
    known = edges.groupBy("instance").agg(F.max("seed").alias("known"))
    support = edges.groupBy("pattern").agg(F.sum("seed").alias("seeds"))
    scores = known.select("instance", F.col("known").cast("double").alias("score"))
    patterns = None
    for _ in range(ROUNDS):
        weighed = edges.join(scores, "instance")
        patterns = pin(weighed.groupBy("pattern").agg((F.sum(F.col("n") * F.col("score")) / (F.sum("n") + 1)).alias("score")))
        means = edges.join(patterns, "pattern").groupBy("instance").agg(
            (F.sum(F.col("n") * F.col("score")) / F.sum("n")).alias("mean")
        )
        scores = means.join(known, "instance").select(
            "instance", F.when(F.col("known") == 1, 1.0).otherwise(F.col("mean")).alias("score")
        )
    good = patterns.filter(F.col("score") >= TRUSTED).join(support.filter(F.col("seeds") >= SEEDS), "pattern")
    return good.select("pattern")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, text_id, base and spans (arrays of start, rank, end, kind) of every document, from its whole text.

    `base` is what the rules find, `spans` adds the identifiers found by context; both are sorted by start and kind,
    in code points, end exclusive. Null text counts as empty and holds nothing, repeated rows give equal rows, an
    empty table gives an empty one.
    """
    text = F.col("text")
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    found = pin(
        rows.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.xxhash64("text").alias("text_id"),
            rule_spans(text).alias("base"),
            _tokens(text).alias("tokens"),
        )
    )

    def seed(t: Column) -> Column:
        return F.exists("base", lambda b: (b["start"] < t["end"]) & (b["end"] > t["start"]))

    marked = F.transform("tokens", lambda t: F.struct(*(t[c].alias(c) for c in ("start", "end", "core", "left", "right")), seed(t).alias("seed")))
    tokens = pin(found.filter(F.size("tokens") > 0).select("row", F.explode(marked).alias("t")).select("row", "t.*"))
    digits = F.length(F.regexp_replace("core", "[^0-9]", ""))
    unknown = tokens.filter(~F.col("seed") & (F.length("core") >= LONG) & (digits >= DIGITS))
    stands = unknown.select("row", "start", "end", F.explode(_patterns(F.struct("core", "left", "right"))).alias("pattern"))
    rank = len(KINDS) - 1
    new = stands.join(trusted_patterns(tokens), "pattern", "left_semi").select(
        "row", _span(F.col("start"), F.col("end"), rank, KINDS[rank]).alias("span")
    )
    added = new.groupBy("row").agg(F.collect_set("span").alias("added"))
    joined = found.select("row", "doc_id", "text_id", "base").join(added, "row", "left")
    every = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "added")))
    return joined.select("doc_id", "text_id", "base", every.alias("spans"))


def _told(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(docs: DataFrame) -> DataFrame:
    """The rows and columns of `docs` with every span replaced by its kind in angle brackets.

    Spans that overlap become one replacement, named by the first. A text without spans stays as it is, null too.
    """
    found = personal_data(docs).filter(F.size("spans") > 0).select(
        F.col("doc_id").alias("__doc"), F.col("text_id").alias("__text"), F.col("spans").alias("__spans")
    )
    found = found.dropDuplicates(["__doc", "__text"])
    same = docs["doc_id"].eqNullSafe(found["__doc"]) & (F.xxhash64(docs["text"]) == found["__text"])
    joined = docs.join(found, same, "left")

    def step(state: Column, s: Column) -> Column:
        piece = F.concat(F.substring(F.col("text"), state["at"] + 1, s["start"] - state["at"]), F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        fresh = (s["start"] >= state["at"])
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(fresh, F.array_append(state["out"], piece)).otherwise(state["out"]).alias("out"),
        )

    rest = F.lit((1 << 31) - 1)
    clean = F.aggregate(
        "__spans",
        F.struct(F.lit(0).alias("at"), _empty("string").alias("out")),
        step,
        lambda state: F.concat(F.array_join(state["out"], ""), F.substring(F.col("text"), state["at"] + 1, rest)),
    )
    kept = [F.when(F.col("__spans").isNull(), F.col("text")).otherwise(clean).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*kept)


def _count(rank: int) -> Column:
    return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")


def op7_pii(spark, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"))
    counts = [_count(rank).alias(f"n_{kind}") for rank, kind in enumerate(RULES)]
    return found.select("doc_id", *counts, F.sha2(_told("base"), 256).alias("base_sha256"), _told("spans").alias("spans"))
