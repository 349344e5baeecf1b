"""Personal data in texts, with SQL expressions only.

Regular expressions propose spans, checksums (Luhn, mod 97) confirm them, and
words near a span raise or lower its score.  Patterns use possessive
repetition so that each runs in linear time and without deep recursion over
texts of any length.

Positions are code points, end exclusive.  They come from cutting the text at
the pattern: the k-th match starts where the pieces and matches before it end.

Null texts count as empty and have no spans; rows are neither dropped nor
merged, so repeated documents each get their own result.  Columns of the input
other than the id and the text are ignored unless asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")

# The patterns of the base kinds in a form that cannot backtrack, and those of the added kinds.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
# A text without this cannot hold the kind.
GUARDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][ -]?[0-9]", "phone": r"\+[0-9]", "iban": r"[A-Z]{2}[0-9]{2}", "ssn": r"[0-9]-[0-9]{2}-[0-9]"}
# Score of a confirmed span, and words that raise or lower it when they stand near.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.4}
NEAR = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "pay"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "bank", "account"),
    "ssn": ("ssn", "social security", "tax id"),
}
FAR = {"email": ("example",), "ip": ("version", "release"), "card": ("order", "serial", "tracking"), "phone": ("order", "serial"), "iban": ("serial",), "ssn": ("part", "model")}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def luhn(digits: str) -> str:
    """SQL condition: a string of digits passes Luhn's check."""
    d = f"cast(substring({digits}, i, 1) AS int)"
    return f"aggregate(sequence(1, length({digits})), 0, (s, i) -> s + if((length({digits}) - i) % 2 = 0, {d}, if({d} > 4, 2 * {d} - 9, 2 * {d}))) % 10 = 0"


def mod97(code: str) -> str:
    """SQL condition: an account code of letters and digits leaves 1 modulo 97."""
    turned = f"concat(substring({code}, 5), left({code}, 4))"
    return f"aggregate(split({turned}, ''), 0, (r, c) -> if(c = '', r, if(c < 'A', (10 * r + cast(if(c < 'A', c, '0') AS int)) % 97, (100 * r + ascii(c) - 55) % 97))) = 1"


# Conditions on a span x(start, end, text) of the text t.
_ALONE = "NOT (x.start > 0 AND substring(t, x.start, 1) RLIKE '[A-Za-z0-9-]') AND NOT substring(t, x.end + 1, 1) RLIKE '[A-Za-z0-9-]'"
CONFIRMED = {
    "email": "true",
    "ip": "forall(split(x.text, '[.]'), p -> length(trim(LEADING '0' FROM p)) < 4 AND coalesce(try_cast(trim(LEADING '0' FROM p) AS int), 0) < 256)",
    "card": f"length({_digits('x.text')}) BETWEEN 13 AND 19 AND {luhn(_digits('x.text'))}",
    "phone": f"length({_digits('x.text')}) BETWEEN 9 AND 15",
    "iban": f"length(replace(x.text, ' ', '')) BETWEEN 15 AND 34 AND {_ALONE} AND {mod97("replace(x.text, ' ', '')")}",
    "ssn": f"{_ALONE} AND left(x.text, 3) NOT IN ('000', '666') AND left(x.text, 1) <> '9' AND substring(x.text, 5, 2) <> '00' AND right(x.text, 4) <> '0000'",
}


def _proposed(kind: str) -> str:
    """SQL array of struct(start, end, text): leftmost matches that do not overlap."""
    pattern = _quoted(PATTERNS[kind])
    found = f"regexp_extract_all(t, {pattern}, 0)"
    cut = f"split(t, {pattern}, -1)"
    step = (
        "(a, x) -> named_struct('at', a.at + length(x.p) + length(x.m), 'out', concat(a.out, array(named_struct("
        "'start', a.at + length(x.p), 'end', a.at + length(x.p) + length(x.m), 'text', x.m))))"
    )
    zero = "named_struct('at', 0, 'out', cast(array() AS array<struct<start:int,end:int,text:string>>))"
    pairs = f"zip_with(slice({cut}, 1, size({found})), {found}, (p, m) -> named_struct('p', p, 'm', m))"
    return f"aggregate({pairs}, {zero}, {step}, a -> a.out)"


def _any(words: tuple[str, ...], text: str) -> str:
    return "(" + " OR ".join(f"contains({text}, {_quoted(w)})" for w in words) + ")"


def _score(kind: str, window: int) -> str:
    near = f"lower(substring(t, greatest(x.start - {window}, 0) + 1, x.end - x.start + least(x.start, {window}) + {window}))"
    return f"least(1.0D, greatest(0.0D, {SCORES[kind]}D + if({_any(NEAR[kind], near)}, 0.3D, 0.0D) - if({_any(FAR[kind], near)}, 0.1D, 0.0D)))"


def personal_data(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), least_score: float = 0.5, window: int = 50) -> DataFrame:
    """Adds ``entities`` to each row: array of (kind, start, end, text, score) by kind as in KINDS, then start.

    Base kinds always stay; an added kind (iban, ssn) stays if its score after
    looking ``window`` characters around is at least ``least_score``.  A null
    or empty text has an empty array.  Output columns: those of ``keep``, ``t``
    (the text, null as empty) and ``entities``.
    """
    own = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("t"))
    empty = "cast(array() AS array<struct<kind:string,start:int,end:int,text:string,score:double>>)"
    for kind in KINDS:
        spans = f"filter({_proposed(kind)}, x -> {CONFIRMED[kind]})"
        scored = f"transform({spans}, x -> named_struct('kind', '{kind}', 'start', x.start, 'end', x.end, 'text', x.text, 'score', {_score(kind, window)}))"
        if kind not in BASE_KINDS:
            scored = f"filter({scored}, x -> x.score >= {least_score}D)"
        guard = f"t RLIKE {_quoted(GUARDS[kind])}" if kind != "email" else "contains(t, '@')"
        own = own.withColumn(f"_{kind}", F.expr(f"if({guard}, {scored}, {empty})"))
    return own.select(*keep, "t", F.concat(*[F.col(f"_{k}") for k in KINDS]).alias("entities"))


def redacted(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Texts with each span replaced by its kind in angle brackets (spans that overlap an earlier one are skipped)."""
    found = personal_data(docs, text, keep)
    step = "(a, x) -> if(x.start < a.at, a, named_struct('at', x.end, 'out', concat(a.out, substring(t, a.at + 1, x.start - a.at), '<', x.kind, '>')))"
    ordered = "array_sort(entities, (l, r) -> if(l.start <> r.start, l.start - r.start, r.end - l.end))"
    return found.select(*keep, F.expr(f"aggregate({ordered}, named_struct('at', 0, 'out', ''), {step}, a -> concat(a.out, substring(t, a.at + 1)))").alias("text"), "entities")


def _listed(entities: Column) -> Column:
    return F.array_join(F.transform(entities, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and span lists per document from the output of :func:`personal_data`."""
    entities = F.col("entities")
    count = lambda kind: F.size(F.filter(entities, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter(entities, lambda x: x["kind"].isin(*BASE_KINDS))
    return found.select(key, *[count(k) for k in BASE_KINDS], F.sha2(_listed(base), 256).alias("base_sha256"), _listed(entities).alias("spans"))
