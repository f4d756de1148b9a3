"""Personal data in texts: patterns propose, checksums confirm, words nearby adjust the score.

Everything is a column expression. A text that lacks the characters a pattern needs is not searched. Patterns
are possessive, so that a run of characters is walked once however long it is.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderwatch.llm.common import text_or_empty

#: Positions are summed in blocks of so many matches, so that a text full of matches costs no square.
BLOCK = 64
NEAR = 40
#: Characters of a piece of the text; what stands around a match is cut from two pieces, not from the text's start.
PIECE = 256
LEAST_SCORE = 0.5


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _digit_count(low: int, high: int) -> Callable[[Column], Column]:
    return lambda hit: F.length(_digits(hit)).between(low, high)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    from_right = F.split(F.reverse(digits), "")
    doubled = F.transform(
        F.filter(from_right, lambda c: c != ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            F.element_at(F.array(*[F.lit(sum(divmod(2 * d, 10))) for d in range(10)]), c.cast("int") + 1)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number with its country code first leaves 1 by 97."""
    plain = F.regexp_replace(account, " ", "")
    moved = F.split(F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4)), "")
    rest = F.aggregate(
        F.filter(moved, lambda c: c != ""),
        F.lit(0),
        lambda a, c: F.when(c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise(
            (a * 100 + F.ascii(c) - 55) % 97
        ),
    )
    return rest == 1


def _account(run: Column) -> Column:
    """The longest beginning of a run of capitals and digits, ending with a word, that is an account number; or null."""
    words = F.split(run, " ")
    beginnings = F.transform(
        F.sequence(F.size(words), F.lit(1), F.lit(-1)), lambda count: F.array_join(F.slice(words, F.lit(1), count), " ")
    )
    passed = lambda part: F.length(F.translate(part, " ", "")).between(15, 34) & ~part.rlike("[a-z]") & mod97(part)
    return F.get(F.filter(beginnings, passed), F.lit(0))


def _card(hit: Column) -> Column:
    return _digit_count(13, 19)(hit) & luhn(_digits(hit))


def _octets(hit: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
    return hit.rlike(rf"^{part}(?:\.{part}){{3}}$")


@dataclass(frozen=True)
class Kind:
    """One kind of span. `needs` is a cheap test of the text, `valid` confirms a match.

    A match scores `score`, plus `lift` if one of the words of `context` stands within NEAR characters of it.
    """

    name: str
    pattern: str
    needs: Callable[[Column], Column]
    valid: Callable[[Column], Column]
    score: float
    lift: float
    context: str
    #: Of a pattern that looks ahead in its first group: the part of match and group that counts, or null.
    taken: Callable[[Column], Column] | None = None


# The four kinds of the contract, in its order. A match of the plain pattern starts where a run starts or where
# the match before ended, which the look-behind and \G say; possessive repeats give the same matches because
# what follows each of them is outside its characters. Fewer digits than asked for never make a match.
BASE = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda text: text.contains("@"),
        lambda hit: F.lit(True),
        0.9,
        0.1,
        "mail|contact|write",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
        lambda text: text.contains("."),
        _octets,
        0.7,
        0.2,
        "ip|addr|host|server",
    ),
    Kind(
        "card",
        r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){12,}+",
        lambda text: text.rlike("[0-9]"),
        _card,
        0.8,
        0.2,
        "card|visa|master|credit|karte|carte|tarjeta",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda text: text.contains("+"),
        _digit_count(9, 15),
        0.7,
        0.2,
        "tel|phone|call|fax|mobil",
    ),
)

#: Characters of an account number by country. Blanks, and what may follow one, are among its characters, so that only
#: its length tells where it ends.
IBAN_LENGTHS = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}
_OF_LENGTH = "|".join(
    rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{length - 4}}}" for length, codes in IBAN_LENGTHS.items()
)
_LISTED = "|".join(" ".join(IBAN_LENGTHS.values()).split())

# What the method adds. Their matches count where the score reaches LEAST_SCORE: an account number by its
# checksum alone, the others only beside a word that names them.
ADDED = (
    Kind(
        "iban",
        rf"(?<![A-Za-z0-9])(?:{_OF_LENGTH})(?![A-Za-z0-9])",
        lambda text: text.rlike("[A-Z]{2}[0-9]{2}"),
        mod97,
        0.7,
        0.3,
        "iban|bank|account|konto|compte|cuenta",
    ),
    # Of a country that the table lacks. Searched apart, so that a run of capitals and digits hides no listed one. Words
    # in capitals may follow, which the pattern looks at without taking them.
    Kind(
        "iban",
        rf"(?<![A-Za-z0-9])(?!{_LISTED})[A-Z]{{2}}[0-9]{{2}}(?=((?:\x20?[A-Z0-9]){{11,30}}+[A-Za-z0-9]*+))",
        lambda text: text.rlike("[A-Z]{2}[0-9]{2}"),
        lambda hit: hit.isNotNull(),
        0.7,
        0.3,
        "iban|bank|account|konto|compte|cuenta",
        taken=lambda run: _account(run),
    ),
    Kind(
        "national_id",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        lambda text: text.contains("-"),
        lambda hit: F.lit(True),
        0.3,
        0.5,
        "ssn|social|security|tax",
    ),
    Kind(
        "local_phone",
        r"(?<![0-9+.)-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
        lambda text: text.rlike("[0-9]{3}[ .-][0-9]{4}"),
        lambda hit: F.lit(True),
        0.3,
        0.4,
        "tel|phone|call|fax|mobil",
    ),
)

SPAN = "struct<kind:string,start:int,end:int,hit:string,score:double>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, also where `body` uses it inside a function of elements."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _positions(text: Column, kind: Kind) -> Column:
    """Every match with its start: what lies between matches comes from splitting at them."""
    size = lambda part: F.aggregate(part, F.lit(0), lambda a, s: a + s["size"])

    def located(block: Column, before: Column) -> Column:
        return F.transform(
            block,
            lambda s, i: F.struct(
                s["hit"].alias("hit"),
                (before + size(F.slice(block, F.lit(1), i)) + s["size"] - s["own"]).alias("start"),
            ),
        )

    def in_blocks(steps: Column) -> Column:
        count = F.ceil(F.size(steps) / BLOCK).cast("int")
        blocks = F.transform(
            F.filter(F.sequence(F.lit(0), count), lambda b: b < count),
            lambda b: F.slice(steps, b * BLOCK + 1, F.lit(BLOCK)),
        )
        summed = F.transform(blocks, lambda part: F.struct(part.alias("part"), size(part).alias("size")))
        return _let(
            summed,
            lambda all_: F.flatten(F.transform(all_, lambda x, b: located(x["part"], size(F.slice(all_, F.lit(1), b))))),
        )

    found = lambda group: F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(group))
    hits, gaps = found(0), F.split(text, kind.pattern, -1)
    arrays = [hits.alias("hit"), gaps.alias("gap")]
    if kind.taken:
        arrays.append(found(1).alias("ahead"))
    steps = F.transform(
        F.filter(F.arrays_zip(*arrays), lambda x: x["hit"].isNotNull()),
        lambda x: F.struct(
            (kind.taken(F.concat(x["hit"], x["ahead"])) if kind.taken else x["hit"]).alias("hit"),
            (F.length(x["gap"]) + F.length(x["hit"])).alias("size"),
            F.length(x["hit"]).alias("own"),
        ),
    )
    return _let(steps, in_blocks)


def _cut_out(pieces: Column, begin: Column, length: Column) -> Column:
    """`length` characters, at most PIECE, of a text in pieces."""
    first = F.floor(begin / PIECE).cast("int")
    two = F.concat(F.coalesce(F.get(pieces, first), F.lit("")), F.coalesce(F.get(pieces, first + 1), F.lit("")))
    return F.substring(two, begin - first * PIECE + 1, length)


def _spans(text: Column, kind: Kind) -> Column:
    def scored(at: Column, pieces: Column) -> Column:
        begin, end = F.greatest(at["start"] - NEAR, F.lit(0)), at["start"] + F.length(at["hit"])
        before, behind = _cut_out(pieces, begin, at["start"] - begin), _cut_out(pieces, end, F.lit(NEAR))
        around = F.lower(F.concat(before, at["hit"], behind))
        near = F.when(around.rlike(rf"(?<![a-z])(?:{kind.context})"), kind.lift).otherwise(0.0)
        return F.struct(
            F.lit(kind.name).alias("kind"),
            at["start"].alias("start"),
            end.alias("end"),
            at["hit"].alias("hit"),
            (F.lit(kind.score) + near).alias("score"),
        )

    valid = F.filter(_positions(text, kind), lambda at: kind.valid(at["hit"]))
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    searched = F.when(
        kind.needs(text) & text.rlike(kind.pattern),
        _let(pieces, lambda cut: F.transform(valid, lambda at: scored(at, cut))),
    )
    return F.coalesce(searched.cast(f"array<{SPAN}>"), F.array().cast(f"array<{SPAN}>"))


def _meets(span: Column, base: Column) -> Column:
    """Whether a span overlaps one of `base`, which are of one kind: in order, and apart from each other."""
    halves = F.array(*[F.lit(1 << power) for power in reversed(range(31))])
    # How many begin before the span ends, found by halves; places beyond the last are null and not taken.
    count = F.aggregate(
        halves,
        F.lit(0),
        lambda low, step: F.when(
            (step <= F.size(base) - low) & (F.get(base, low + step - 1)["start"] < span["end"]), low + step
        ).otherwise(low),
    )
    return F.coalesce(F.get(base, count - 1)["end"] > span["start"], F.lit(False))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id and `spans`, an array of kind, start, end (code points, end exclusive), hit and score.

    Spans are ordered by kind as listed, then start. Base kinds are all kept; an added span is dropped below
    LEAST_SCORE or where it overlaps a base one. A null text counts as empty; an empty text has no spans; repeated
    rows are judged one by one; other columns are neither read nor returned. The work grows with the text and its
    matches, not with their square.
    """
    text = F.col("_text")
    found = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("_text"))
    names = list(dict.fromkeys(kind.name for kind in ADDED))
    of_name = lambda name: F.concat(*[_spans(text, kind) for kind in ADDED if kind.name == name])
    searched = found.select(
        "doc_id",
        *[_spans(text, kind).alias(f"base_{kind.name}") for kind in BASE],
        F.concat(*[F.array_sort(of_name(name)) for name in names]).alias("added"),
    )
    base = [f"base_{kind.name}" for kind in BASE]

    def apart(span: Column) -> Column:
        kept = span["score"] >= LEAST_SCORE
        for name in base:
            kept = kept & ~_meets(span, F.col(name))
        return kept

    return searched.select("doc_id", F.concat(*base, F.filter("added", apart)).alias("spans"))


def span_list(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
