"""Personal data by weak supervision: labelers vote on spans, EM weighs the labelers, and its posteriors train a classifier.

Spark's own functions throughout: the driver sees counts of vote patterns and of feature slots, whose numbers are fixed.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from math import exp, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

KINDS = ("email", "ip", "card", "phone")
NEAR = 40  # code points of context on either side of a span
COMPANY = 200  # code points within which another base span is company
ROUNDS = 50  # of expectation maximisation
SLOTS = 256  # of each feature of a kind
PRIOR = 20.0  # rows that the first belief about a labeler counts for

# Base patterns, as matched leftmost and non-overlapping. Possessive quantifiers and lookbehinds find the same matches
# without going back; \G lets a match begin right behind the last one.
LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Chains of fewer than 13 digits cannot hold, and no other match begins in them.
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
AT = r"\x20?[\[({]\x20?(?i:at|@)\x20?[\])}]\x20?"
DOT = r"\x20?[\[({]\x20?(?i:dot|\.)\x20?[\])}]\x20?"
HEX = "[0-9A-Fa-f]{1,4}"
OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# Further spellings, one pattern a kind. Their spans are added if the classifier is sure enough.
WIDE = {
    "email": rf"(?<![{LOCAL}])[{LOCAL}]++(?:(?:{AT})[A-Za-z0-9-]++(?:(?:{DOT}|\x20(?i:dot)\x20|\.)[A-Za-z0-9-]++)++"
    rf"|\x20(?i:at)\x20[A-Za-z0-9-]++(?:\x20(?i:dot)\x20[A-Za-z0-9-]++)++"
    rf"|@[A-Za-z0-9-]++(?:(?:{DOT}|\x20(?i:dot)\x20)[A-Za-z0-9-]++)++)",
    "ip": rf"(?<![0-9A-Za-z:.])(?:(?:{HEX}:){{7}}{HEX}|(?:{HEX}:){{1,6}}(?::{HEX}){{1,6}}|(?:{HEX}:){{2,6}}:"
    rf"|{OCTET}(?:(?:{DOT}|\x20(?i:dot)\x20){OCTET}){{3}})(?![0-9A-Za-z:]|\.[0-9])",
    "card": r"(?<![0-9A-Za-z.+-])(?:[0-9]{4}(?:([./_]|\x20-\x20|\x20{2})[0-9]{4})(?:\1[0-9]{4})\1[0-9]{1,7}"
    r"|3[47][0-9]{2}([./_]|\x20{2})[0-9]{6}\2[0-9]{5})(?![0-9A-Za-z]|[.-][0-9])",
    "phone": r"(?<![0-9A-Za-z+.(-])(?:\([0-9]{2,4}\)\x20?[0-9]{3,4}[\x20.-][0-9]{3,4}|[0-9]{3}([.\x20-])[0-9]{3}\1[0-9]{4}"
    r"|00[1-9][0-9]{0,2}(?:[\x20./-]?[0-9]{2,4}){2,5}|0[1-9][0-9]{1,3}[\x20/-][0-9]{5,8})(?![0-9A-Za-z]|[.-][0-9])",
}

# Gazetteers, in the languages of the usual corpora.
CUES = {
    "email": ["e-?mails?", "mail", "mailto", "contact", "kontakt", "contacto", "correos?", "courriel", "write", "schreib\\w*", "adress?e?"],
    "ip": ["ip", "ips", "ipv4", "ipv6", "address", "adresse", "direcci[oó]n", "host", "server", "client", "login", "logged", "from"],
    "card": ["cards?", "visa", "mastercard", "amex", "credit", "debit", "karten?\\w*", "kreditkarte", "tarjeta", "carte", "cc", "payment"],
    "phone": ["tel", "tél", "phone", "telephone", "telefon", "tel[eé]fono", "t[eé]l[eé]phone", "call", "mobile?", "m[oó]vil", "handy", "cell", "fax", "whatsapp", "sms"],
}
OTHERWISE = ["version", "release", "build", "isbn", "issn", "doi", "order", "invoice", "ticket", "serial", "sku", "id", "sha", "hash", "chapter", "section", "figure", "page"]
ENDINGS = ["com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "us", "eu", "ch", "at", "it", "nl", "be", "br", "mx", "ca", "ru", "pl", "in", "jp", "cn"]
NUMBERS = r"^(?:1[2-9][0-9]{2}|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-9][0-9]|3[578][0-9]|4[2][0-9]|5[09][0-9]|6[789][0-9]|8[057][0-9]|9[679][0-9])"
ISSUERS = "^(?:4|5[1-5]|2[2-7]|3[4-9]|6[0245])"
SPECIAL = r"^(?:0|10|127|169\.254|192\.168|172\.(?:1[6-9]|2[0-9]|3[01])|22[4-9]|2[34][0-9]|25[0-5])\."

LABELERS = ("form", "check", "gazetteer", "before", "edges", "company")
FEATURES = ("shape", "word_before", "word_after", "separators", "size")


def matches(text: Column, kind: str, wide: bool) -> Column:
    """The pieces between the matches of a kind's pattern, each with the match behind it; null without matches.

    Of a piece only its length and both ends are kept: the start of a match is a sum of lengths before it.
    """
    pattern = (WIDE if wide else BASE)[kind]
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    joined = F.zip_with(
        pieces,
        found,
        lambda piece, match: F.struct(
            F.lit(kind).alias("kind"),
            F.lit(wide).alias("wide"),
            F.char_length(piece).cast("long").alias("gap"),
            F.left(piece, F.lit(NEAR)).alias("head"),
            F.right(piece, F.lit(NEAR)).alias("before"),
            match.alias("match"),
        ),
    )
    return F.when(text.rlike(pattern), F.transform(joined, lambda x, i: F.struct(i.alias("place"), x.alias("x"))))


def luhn(digits: Column) -> Column:
    """Whether the check digit of 13 to 19 digits is right."""

    def value(i: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, digit).when(digit > 4, 2 * digit - 9).otherwise(2 * digit)

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda total, i: total + value(i))
    return F.when(F.length(digits).between(13, 19), total % 10 == 0).otherwise(False)


def by_kind(**columns: Column) -> Column:
    return reduce(lambda done, kind: done.when(F.col("kind") == kind, columns[kind]), KINDS[1:], F.when(F.col("kind") == KINDS[0], columns[KINDS[0]]))


def vote(yes: Column, no: Column | None = None) -> Column:
    """1, -1 or, where the labeler has no opinion, 0."""
    said = F.when(yes, 1)
    return (said.when(no, -1) if no is not None else said).otherwise(0)


def valid() -> Column:
    """Whether a span is what its kind must be."""
    octets = F.forall(F.split("match", r"\.", -1), lambda part: part.rlike("^0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])$"))
    return by_kind(
        email=F.lit(True),
        # Short names of the shape a::b are no addresses.
        ip=F.when(F.col("wide"), F.col("match").rlike("[0-9]") & (F.char_length("match") >= 8)).otherwise(octets),
        card=luhn(F.col("digits")),
        phone=F.length("digits").between(9, 15),
    )


def any_word(words: Iterable[str]) -> str:
    return rf"(?iu)(?<![\p{{L}}\p{{N}}])(?:{'|'.join(words)})(?![\p{{L}}\p{{N}}])"


def votes() -> list[Column]:
    """One column for each labeler: a regex, checks, gazetteers and the context vote for (1) or against (-1) a span."""
    match, digits = F.col("match"), F.col("digits")
    ending = F.lower(F.regexp_extract(match, "([A-Za-z0-9-]+)[^A-Za-z0-9]*$", 1))
    cue = by_kind(**{kind: F.col("before").rlike(any_word(words)) for kind, words in CUES.items()})
    edge = F.concat(F.right("before", F.lit(1)), F.lit(" "), F.left("after", F.lit(1)))
    columns = {
        "form": vote(~F.col("wide") & F.col("valid"), ~F.col("valid")),
        "check": by_kind(
            email=vote(ending.rlike("^[a-z]{2,24}$"), ending.rlike("^[0-9]+$")),
            ip=vote(F.col("valid"), ~F.col("valid")),
            card=vote(F.col("valid"), ~F.col("valid")),
            phone=vote(F.length(digits).between(10, 13), ~F.col("valid")),
        ),
        "gazetteer": by_kind(
            email=vote(ending.isin(ENDINGS)),
            ip=vote(F.lit(False), ~F.col("wide") & match.rlike(SPECIAL)),
            card=vote(digits.rlike(ISSUERS), ~digits.rlike(ISSUERS)),
            phone=vote(F.ltrim(digits, F.lit("0")).rlike(NUMBERS)),
        ),
        "before": vote(cue, F.col("before").rlike(any_word(OTHERWISE))),
        "edges": vote(F.lit(False), edge.rlike(r"[\p{L}\p{N}_/=]")),
        "company": vote(F.col("company") > 0),
    }
    return [columns[name].cast("byte").alias(name) for name in LABELERS]


def features() -> list[Column]:
    """What the classifier sees beside the votes."""
    shape = F.regexp_replace(F.regexp_replace("match", "[0-9]+", "9"), "[A-Za-z]+", "a")
    return [
        shape,
        F.lower(F.regexp_extract("before", r"([\p{L}\p{N}]+)[^\p{L}\p{N}]*$", 1)),
        F.lower(F.regexp_extract("after", r"^[^\p{L}\p{N}]*([\p{L}\p{N}]+)", 1)),
        F.concat_ws("|", F.right("before", F.lit(1)), F.left("after", F.lit(1))),
        F.length("digits").cast("string"),
    ]


def candidates(docs: DataFrame, text: str, id: str) -> DataFrame:
    """A row for each match of a pattern, and one without for each text that has none. ``row`` numbers the texts."""
    content = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    none = F.array().cast("array<struct<place:int,x:struct<kind:string,wide:boolean,gap:bigint,head:string,before:string,match:string>>>")
    all_of = F.flatten(F.array(*[F.coalesce(matches(F.col("text"), kind, wide), none) for wide in (False, True) for kind in KINDS]))
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id}`").alias("id"), content.alias("text"))
    pieces = texts.select("row", "id", F.explode_outer(all_of).alias("piece")).select("row", "id", "piece.place", "piece.x.*")
    # All windows below, and the lists at the end, are those of one text: this is the only shuffle for them.
    pieces = pieces.repartition("row")
    along = Window.partitionBy("row", "kind", "wide").orderBy("place")
    size = F.coalesce(F.char_length("match").cast("long"), F.lit(0))
    placed = pieces.select(
        "*",
        (F.sum(F.col("gap") + size).over(along.rowsBetween(Window.unboundedPreceding, 0)) - size).alias("start"),
        F.coalesce(F.lead("head").over(along), F.lit("")).alias("after"),
        F.regexp_replace("match", "[^0-9]", "").alias("digits"),
    ).where("match IS NOT NULL OR kind IS NULL")
    checked = placed.select("*", (F.col("start") + F.char_length("match")).alias("stop"), valid().alias("valid"))
    checked = checked.withColumn("base", F.coalesce(~F.col("wide") & F.col("valid"), F.lit(False)))
    own = F.col("base").cast("int")
    around = Window.partitionBy("row").orderBy("start").rangeBetween(-COMPANY, COMPANY)
    checked = checked.withColumn("company", F.sum(own).over(around) - own)
    slots = F.array(*[
        F.pmod(F.xxhash64("kind", F.lit(i), value), F.lit(SLOTS)).cast("int") + i * SLOTS for i, value in enumerate(features())
    ])
    return checked.select("row", "id", "kind", "wide", "valid", "base", "start", "stop", "match", *votes(), slots.alias("slots"))


def sigmoid(x: float) -> float:
    return 1 / (1 + exp(-x)) if x > -700 else 0.0


def reliabilities(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[float, list[list[float]]]:
    """By expectation maximisation over counted vote patterns: the log odds of a true span, and of each labeler's votes
    -1, 0 and 1, given that labelers err independently. The first belief, that most votes are right, counts
    for `PRIOR` rows of either class, so that few candidates do not turn it round."""
    first = {1: [0.05, 0.35, 0.6], 0: [0.4, 0.5, 0.1]}
    share = 0.5
    table = {c: [list(first[c]) for _ in LABELERS] for c in (0, 1)}

    def weights() -> tuple[float, list[list[float]]]:
        ratios = [[log(a / b) for a, b in zip(*rows, strict=True)] for rows in zip(table[1], table[0], strict=True)]
        # A labeler may be worthless, but its votes never count for the opposite: the classes keep their meaning.
        return log(share / (1 - share)), [[min(no, 0.0), none, max(yes, 0.0)] for no, none, yes in ratios]

    for _ in range(ROUNDS):
        odds, ratios = weights()
        counts = {c: [[PRIOR * p for p in first[c]] for _ in LABELERS] for c in (0, 1)}
        true, total = PRIOR, 2 * PRIOR
        for pattern, n in patterns:
            p = sigmoid(odds + sum(ratio[v + 1] for ratio, v in zip(ratios, pattern, strict=True)))
            true, total = true + n * p, total + n
            for at, v in enumerate(pattern):
                counts[1][at][v + 1] += n * p
                counts[0][at][v + 1] += n * (1 - p)
        share = true / total
        table = {c: [[x / sum(row) for x in row] for row in counts[c]] for c in (0, 1)}
    return weights()


def literal(values: Iterable[float]) -> Column:
    return F.expr(f"array({', '.join(f'{v!r}D' for v in values)})")


def find_personal_data(docs: DataFrame, text: str = "text", id: str = "doc_id", sure: float = 0.9) -> DataFrame:
    """(``id``, ``spans``) of every row: spans of personal data as ``kind``, ``start``, ``stop`` (code points, exclusive),
    ``base``, ``score`` and ``match``, by kind as in `KINDS` and then by start.

    Base spans, the leftmost non-overlapping matches of `BASE` that hold (`valid`), are always kept. Matches of the
    further spellings in `WIDE` are added if the final classifier gives them ``sure`` or more, they hold, and they
    overlap no base span. Labelers vote on all of them and on the matches that do not hold; expectation maximisation
    finds, kind by kind, how reliable each labeler is, and its posteriors train a naive Bayes classifier over the votes and
    hashed features of the span and its context. Both see counts over all texts: at most 3^6 patterns and
    5 * `SLOTS` slots a kind reach the driver, whatever the input.

    Null and empty texts have no spans. Every row has its own result, repeated rows and null ids too; other
    columns stay behind. A text is matched by one task, and of its matches only their surroundings are shuffled.
    """
    found = materialise(candidates(docs, text, id), "personal-data")
    spans = found.where("kind IS NOT NULL")
    counted: dict[str, list] = {kind: [] for kind in KINDS}
    for r in spans.groupBy("kind", *LABELERS).agg(F.count("*").alias("n")).collect():  # 4 * 3^6 rows at most
        counted[r["kind"]].append((tuple(r[name] for name in LABELERS), r["n"]))
    learnt = {kind: reliabilities(sorted(counted[kind])) for kind in KINDS}

    def belief(kind: str) -> Column:
        odds, ratios = learnt[kind]
        terms = (F.element_at(literal(ratio), F.col(name).cast("int") + 2) for name, ratio in zip(LABELERS, ratios, strict=True))
        return reduce(Column.__add__, terms, F.lit(odds))

    def probability(x: Column) -> Column:
        return 1 / (1 + F.exp(-x))

    believed = spans.select("kind", "slots", probability(by_kind(**{kind: belief(kind) for kind in KINDS})).alias("p"))
    seen = believed.select("kind", "p", F.explode("slots").alias("slot")).groupBy("kind", "slot").agg(
        F.sum("p").alias("true"), F.sum(1 - F.col("p")).alias("false")
    )
    slots = {kind: [0.0] * (SLOTS * len(FEATURES)) for kind in KINDS}
    rows = seen.collect()  # 4 * 5 * SLOTS at most
    for kind in KINDS:
        own = [r for r in rows if r["kind"] == kind]
        # A slot weighs by how its odds differ from those of all spans, as far as PRIOR rows do not outweigh it.
        true, false = (sum(r[c] for r in own) / len(FEATURES) + 1 for c in ("true", "false"))
        for r in own:
            expected = true / (true + false)
            p = (r["true"] + PRIOR * expected) / (r["true"] + r["false"] + PRIOR)
            slots[kind][r["slot"]] = log(p / (1 - p)) - log(expected / (1 - expected))

    def trained(kind: str) -> Column:
        weights = literal(slots[kind])
        return F.aggregate("slots", belief(kind), lambda total, slot: total + F.element_at(weights, slot + 1))

    scored = found.withColumn("score", probability(by_kind(**{kind: trained(kind) for kind in KINDS})))
    in_order = Window.partitionBy("row").orderBy("start", F.col("base").desc())
    stop_before = F.max(F.when(F.col("base"), F.col("stop"))).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    start_after = F.min(F.when(F.col("base"), F.col("start"))).over(in_order.rowsBetween(0, Window.unboundedFollowing))
    apart = (F.coalesce(stop_before, F.lit(0)) <= F.col("start")) & (F.coalesce(start_after, F.col("stop")) >= F.col("stop"))
    scored = scored.select("*", apart.alias("apart"))
    kept = F.col("base") | (F.col("wide") & F.col("valid") & F.col("apart") & (F.col("score") >= sure))
    number = by_kind(**{kind: F.lit(i) for i, kind in enumerate(KINDS)})
    span = F.struct(number.alias("number"), "start", "stop", "kind", "base", "score", "match")
    listed = scored.groupBy("row", "id").agg(F.sort_array(F.collect_list(F.when(kept, span))).alias("spans"))
    fields = ("kind", "start", "stop", "base", "score", "match")
    return listed.select(
        F.col("id").alias(id),
        F.transform("spans", lambda s: F.struct(*[s[name].alias(name) for name in fields])).alias("spans"),
    )
