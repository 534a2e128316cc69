"""Personal data found with DataFrame functions alone.

Regular expressions propose spans of each kind, validators confirm them (part ranges for addresses, Luhn for cards,
digit counts for phones, mod-97 for IBANs, letters and digits for secrets), and context words near a span adjust its
score. Spans of the base kinds (email, ip, card, phone) that pass their validator are always reported, with their score;
IBANs, social security numbers and secrets (keys, tokens) are reported from a score of 0.6, so that the last two need
context, unless a secret's form gives it away. Context is what stands within 40 characters of a span and not beyond the
next span of its kind.

The patterns are written with possessive loops and look-behinds that start a match only where a run starts, so that
long runs cost linear time and no recursion; the matches are those of the plain patterns. Offsets are code points, end
exclusive, summed over the pieces between matches (``split`` and ``regexp_extract_all`` of one pattern), by blocks of
about the root of their number: n matches in a text cost n to the power 1.5 small steps.

Nulls: a null text counts as empty and has no spans. Ids, repeated rows and other columns pass through untouched; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import documents, text_of

BASE_KINDS = ["email", "ip", "card", "phone"]
LEAST_SCORE = 0.6
CONTEXT_CHARS = 40

PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "secret": r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+",
}
#: Secrets that their form gives away: access keys, service tokens, signed tokens. Others need context.
KNOWN_SECRET = r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9_-]{20,}|eyJ[A-Za-z0-9_-]{20,})$"
#: A substring without which a kind can't occur; it spares the pattern.
NEEDS = {"email": "@", "phone": "+"}
CONTEXT = {
    "email": r"(?i)e-?mail|contact|write to|reach",
    "ip": r"(?i)\bip\b|address|server|host|login",
    "card": r"(?i)card|visa|credit|debit|payment",
    "phone": r"(?i)phone|call|tel\b|mobile|fax",
    "iban": r"(?i)iban|bank|account|konto|transfer",
    "ssn": r"(?i)\bssn\b|social security",
    "secret": r"(?i)token|secret|passw|\bkey\b|api[_-]?key|credential|bearer",
}
#: Score of a confirmed span; context adds 0.2 (0.4 for ssn and secret, which have no checksum and are not reported without).
SCORE = {"email": 0.6, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.4, "secret": 0.4}
BONUS = {"ssn": 0.4, "secret": 0.4}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"


def _mod97(value: Column) -> Column:
    bare = F.regexp_replace(value, " ", "")
    chars = F.split(F.concat(F.substring(bare, 5, 40), F.substring(bare, 1, 4)), "")
    def step(acc: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97)

    return F.aggregate(F.filter(chars, lambda c: c != ""), F.lit(0), step) == 1


def confirmed(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    return {
        "email": lambda: F.lit(True),
        "ip": lambda: F.rlike(value, F.lit(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$")),
        "card": lambda: F.length(digits).between(16, 19) & F.call_function("luhn_check", digits),
        "phone": lambda: F.length(digits).between(8, 15),
        "iban": lambda: _mod97(value),
        "ssn": lambda: ~F.rlike(value, F.lit("^(?:000|666|9)|-00-|-0000$")),
        "secret": lambda: F.rlike(value, F.lit("[0-9].*[0-9]")) & F.rlike(value, F.lit("[A-Za-z].*[A-Za-z]")),
    }[kind]()


STEP = "array<struct<gap:int,len:int,value:string,before:string,after:string>>"
FOUND = "array<struct<start:int,end:int,value:string,before:string,after:string>>"
SPANS = "array<struct<kind:string,start:int,end:int,value:string,score:double>>"


def _steps(text: Column, pattern: str, matches: Column) -> Column:
    """Per match: the length of the gap before it, its own, its value, and the characters around it, up to
    CONTEXT_CHARS on a side and not beyond the next match."""
    gaps = F.split(text, pattern, -1)
    sides = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), F.slice(gaps, F.lit(2), F.size(matches)), lambda g, n: F.struct(F.length(g).alias("gap"), F.right(g, F.lit(CONTEXT_CHARS)).alias("before"), F.left(n, F.lit(CONTEXT_CHARS)).alias("after")))
    return F.zip_with(sides, matches, lambda g, m: F.struct(g["gap"].alias("gap"), F.length(m).alias("len"), m.alias("value"), g["before"].alias("before"), g["after"].alias("after")))


def _blocks(steps: str) -> Column:
    """The steps in blocks of about the root of their number."""
    width = F.ceil(F.sqrt(F.size(steps))).cast("int")
    return F.transform(F.sequence(F.lit(1), F.size(steps), width), lambda i: F.slice(steps, i, width))


def _placed(blocks: str) -> Column:
    """Start, end, value and surroundings of each match: running sums of gaps and lengths, first over the blocks, then
    inside each, so that no array longer than a block is rebuilt for each match."""

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + x["len"]
        here = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"), x["before"].alias("before"), x["after"].alias("after"))
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(here)).alias("found"))

    def next_block(acc: Column, n: Column) -> Column:
        return F.struct((acc["at"] + n).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all"))

    sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda acc, x: acc + x["gap"] + x["len"]))
    starts = F.aggregate(sums, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")), next_block, lambda acc: acc["all"])
    inside = lambda b, at: F.aggregate(b, F.struct(at.alias("at"), F.array().cast(FOUND).alias("found")), add, lambda acc: acc["found"])
    return F.flatten(F.zip_with(blocks, starts, inside))


def _scored(kind: str, found: Column) -> Column:
    def shaped(x: Column) -> Column:
        context = F.rlike(F.concat(x["before"], F.lit(" "), x["after"]), F.lit(CONTEXT[kind]))
        first = F.lit(SCORE[kind])
        if kind == "secret":
            first = F.when(F.rlike(x["value"], F.lit(KNOWN_SECRET)), 0.8).otherwise(first)
        score = first + F.when(context, BONUS.get(kind, 0.2)).otherwise(0.0)
        return F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"), score.alias("score"))

    scored = F.transform(F.filter(found, lambda x: confirmed(kind, x["value"])), shaped)
    return scored if kind in BASE_KINDS else F.filter(scored, lambda x: x["score"] >= LEAST_SCORE)


def find_pii(docs: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """Add an array of (kind, start, end, value, score), ordered by kind as listed in PATTERNS, then by start."""
    text = text_of(text_col)
    name = lambda step, kind: f"__pii_{step}_{kind}"
    matches, steps, blocks, spans = {}, {}, {}, []
    for kind, pattern in PATTERNS.items():
        m = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        matches[name("m", kind)] = F.when(F.contains(text, F.lit(NEEDS[kind])), m).otherwise(F.array().cast("array<string>")) if kind in NEEDS else m
        own = F.col(name("m", kind))
        steps[name("s", kind)] = F.when(F.size(own) > 0, _steps(text, pattern, own)).otherwise(F.array().cast(STEP))
        # each step names the one before at least twice, so that plans keep it as a column of its own and work it out once
        cut = name("s", kind)
        blocks[name("b", kind)] = F.when(F.size(cut) > 0, _blocks(cut)).otherwise(F.array().cast(f"array<{STEP}>"))
        dealt = name("b", kind)
        spans.append(F.when(F.size(dealt) > 0, _scored(kind, _placed(dealt))).otherwise(F.array().cast(SPANS)))
    seen = docs.withColumns(matches).withColumns(steps).withColumns(blocks)
    return seen.withColumn(spans_col, F.concat(*spans)).drop(*matches, *steps, *blocks)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def op6_pii(spark, sf_dir):
    found = find_pii(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "spans")
    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda x: x["kind"].isin(BASE_KINDS))
    best = F.array_max(F.transform("spans", lambda x: x["score"]))
    more = [count(kind) for kind in PATTERNS if kind not in BASE_KINDS]
    return found.select("doc_id", *map(count, BASE_KINDS), F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"), *more, F.size("spans").cast("long").alias("n_spans"), best.alias("best_score"))


QUERIES = {"op6_pii": op6_pii}
SQL: dict[str, str] = {}
