"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, text_of

# The patterns. Each starts where the leftmost match can (a run's start, or where the last match ended) and
# gives nothing back once taken, so that a long run without a match is read once (account numbers: a bounded number of signs).
_START = r"(?:\G|(?<![{0}]))"
EMAIL = _START.format("A-Za-z0-9._%+-") + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?=[0-9])" + _START.format("0-9") + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?=[0-9])" + _START.format("0-9") + r"[0-9](?:[\x20-]?[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Signs of an account number by country (the registry of ISO 13616).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_LISTED = "(?:" + "|".join(x.replace(" ", "|") for x in IBAN_LENGTHS.values()) + ")[0-9]{2}"
_BY_LENGTH = "|".join(f"(?:{x.replace(' ', '|')})[0-9]{{2}}(?:[\\x20]?[A-Z0-9]){{{n - 4}}}" for n, x in IBAN_LENGTHS.items())
# the country fixes how many signs are taken, so that what follows is never read as part; other pairs of letters take up to 34 signs
IBAN = rf"(?<![A-Za-z0-9])(?:{_BY_LENGTH}|(?!{_LISTED})[A-Z]{{2}}[0-9]{{2}}(?:(?:\x20(?!{_LISTED}))?[A-Z0-9]){{11,30}})(?![A-Za-z0-9])"
NATIONAL_ID = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
KINDS = ("email", "ip", "card", "phone", "iban", "id")
#: Spans whose numbers redact() keeps in one list.
REDACT_BLOCK = 256
#: Score of a span by kind before its context is looked at, and what a word nearby adds.
BASE_SCORES = {"email": 0.8, "ip": 0.7, "card": 0.8, "phone": 0.6, "iban": 0.8, "id": 0.3}
CONTEXT = {
    "email": "e-?mail|contact|write|courriel|correo",
    "ip": "ip|host|server|address|login",
    "card": "card|visa|credit|payment|carte|karte|tarjeta",
    "phone": "phone|call|tel|mobile|fax|whatsapp",
    "iban": "iban|account|bank|transfer|konto|compte|cuenta",
    "id": "ssn|social security|national id|passport|tax",
}
CONTEXT_CHARS, CONTEXT_GAIN, KEEP_FROM = 40, 0.3, 0.5
#: A sign that no pattern has stands for the ends of matches; where the text has it itself, another takes its place.
_MARK, _OTHER = "\x01", "\x02"


def _let(value: Column, use) -> Column:
    """use(value), with the value worked out once; a lambda's body would work it out for each element."""
    return F.transform(F.array(value), use)[0]


def _matches(text: Column, pattern: str) -> Column:
    """(start, end, value, near) of the leftmost matches that don't overlap, in code points from 0. near: up to CONTEXT_CHARS
    characters before the match, from as far back as three matches, a blank, and up to as many after it.

    Marks around the matches cut the text into parts, every second of them a match. Starts are sums of lengths: first for
    blocks of about the square root of all parts, then within each, so that no long array is copied for each match."""
    marked = F.regexp_replace(F.translate(text, _MARK, _OTHER), f"({pattern})", f"{_MARK}$1{_MARK}")

    def of(parts: Column) -> Column:
        block = (F.ceil(F.sqrt(F.size(parts)) / 2) * 2).cast("int")  # even, so that matches stand at odd places of each block
        begins = F.sequence(F.lit(0), F.size(parts) - 1, block)
        return _let(F.transform(parts, lambda p: F.length(p)), lambda lengths: _let(block, lambda n: _let(_sums(F.transform(begins, lambda b: F.aggregate(F.slice(lengths, b + 1, n), F.lit(0), lambda s, x: s + x))), lambda starts: F.flatten(F.transform(begins, lambda b, i: within(parts, lengths, b, n, starts[i]))))))

    def within(parts: Column, lengths: Column, b: Column, n: Column, start: Column) -> Column:
        found = _let(_sums(F.slice(lengths, b + 1, n)), lambda at: F.transform(F.slice(parts, b + 1, n), lambda p, i: F.when(i % 2 == 1, F.struct((start + at[i]).alias("start"), (start + at[i] + F.length(p)).alias("end"), p.alias("value"), near(parts, b + i).alias("near")))))
        return F.filter(found, lambda m: m.isNotNull())

    def near(parts: Column, i: Column) -> Column:
        before = F.concat(*[F.right(F.coalesce(F.get(parts, i - k), F.lit("")), F.lit(CONTEXT_CHARS)) for k in range(7, 0, -1)])
        after = F.concat(*[F.left(F.coalesce(F.get(parts, i + k), F.lit("")), F.lit(CONTEXT_CHARS)) for k in range(1, 8)])
        return F.concat(F.right(before, F.lit(CONTEXT_CHARS)), F.lit(" "), F.left(after, F.lit(CONTEXT_CHARS)))

    return _let(F.split(marked, _MARK, -1), of)


def _sums(lengths: Column) -> Column:
    """The sum of what stands before each element of a short array."""
    step = lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["all"], F.array(s["at"])).alias("all"))
    return F.aggregate(lengths, F.expr("named_struct('at', 0, 'all', cast(array() as array<int>))"), step, lambda s: s["all"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes: every second digit from the right doubled, the sum a multiple of ten."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number passes: four signs moved to the end, letters as 10 to 35, one more than a multiple of 97."""
    plain = F.regexp_replace(iban, " ", "")
    turned = F.split(F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4)), "")

    def step(rest: Column, sign: Column) -> Column:
        value = F.when(sign.rlike("[0-9]"), sign.cast("int")).otherwise(F.ascii(sign) - 55)
        return F.when(sign == "", rest).otherwise((rest * F.when(value > 9, 100).otherwise(10) + value) % 97)

    return F.aggregate(turned, F.lit(0), step) == 1


def _checks(kind: str, value: Column) -> Column:
    digits = F.length(_digits(value))
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike("^([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return digits.between(12, 19) & luhn(_digits(value))
    if kind == "phone":
        return digits.between(9, 15)
    if kind == "iban":
        return mod97(value)
    return F.lit(True)


def spans(docs: DataFrame, text_col: str = "text", out: str = "pii") -> DataFrame:
    """docs with a column `out`: an array of (kind, start, end, value, score) by start, then kind in the order of KINDS.

    Starts and ends count code points of the whole text. Emails, ip addresses, cards and phones that pass their checks
    are always there, whatever their score; account numbers (mod 97) and national ids are there from KEEP_FROM on, which
    a national id reaches only with a word for it nearby. Null and empty texts have none. `out` replaces a column of its name.
    All of it is column expressions; patterns that need a sign which a text hasn't are not run on it.
    """
    text = text_of(docs, text_col)
    patterns = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "iban": IBAN, "id": NATIONAL_ID}
    needs = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+")), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]"), "iban": text.rlike("[A-Z]{2}[0-9]{2}"), "id": text.rlike("[0-9]-[0-9]{2}-[0-9]")}
    none = F.expr("cast(array() as array<struct<kind:string,rank:int,start:int,end:int,value:string,score:double>>)")

    def of(kind: str) -> Column:
        checked = F.filter(_matches(text, patterns[kind]), lambda m: _checks(kind, m["value"]))

        def scored(m: Column) -> Column:
            gain = F.when(F.lower(m["near"]).rlike(rf"\b({CONTEXT[kind]})\b"), CONTEXT_GAIN).otherwise(0.0)
            return F.struct(F.lit(kind).alias("kind"), F.lit(KINDS.index(kind)).alias("rank"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value"), F.least(F.lit(1.0), F.lit(BASE_SCORES[kind]) + gain).alias("score"))

        found = F.transform(checked, scored)
        if kind in ("iban", "id"):
            found = F.filter(found, lambda s: s["score"] >= KEEP_FROM)
        return F.when(needs[kind], found).otherwise(none)

    def before(a: Column, b: Column) -> Column:
        return F.when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1)).otherwise(F.when(a["rank"] < b["rank"], -1).when(a["rank"] > b["rank"], 1).otherwise(0))

    every = F.array_sort(F.concat(*[of(k) for k in KINDS]), before)
    return docs.withColumn(out, F.transform(every, lambda s: s.dropFields("rank")))


def listed(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with each span that doesn't begin inside an earlier one replaced by its kind in angle brackets. A null text stays
    null; all other columns stay. Pieces between spans are cut once each and joined at the end."""
    out = free_name(docs, "pii")
    held = spans(docs, text_col, out)
    text = F.col(text_col)
    none = F.expr("cast(array() as array<int>)")
    many = F.expr("cast(array() as array<array<int>>)")

    def step(s: Column, k: Column) -> Column:
        """The spans of a block that stay, by their number."""
        m = F.get(F.col(out), k)
        free = m["start"] >= s["at"]
        return F.struct(F.when(free, m["end"]).otherwise(s["at"]).alias("at"), F.when(free, F.concat(s["kept"], F.array(k))).otherwise(s["kept"]).alias("kept"))

    def block(s: Column, b: Column) -> Column:
        """Lists of numbers stay short, for each step copies one: those of a block, and the list of blocks."""
        numbers = F.sequence(b * REDACT_BLOCK, F.least((b + 1) * REDACT_BLOCK, F.size(out)) - 1)
        own = F.aggregate(numbers, F.struct(s["at"].alias("at"), none.alias("kept")), step)
        return _let(own, lambda o: F.struct(o["at"].alias("at"), F.concat(s["kept"], F.array(o["kept"])).alias("kept")))

    blocks = F.when(F.size(out) > 0, F.sequence(F.lit(0), F.floor((F.size(out) - 1) / REDACT_BLOCK).cast("int"))).otherwise(none)
    stay = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), many.alias("kept")), block, lambda s: F.flatten(s["kept"]))

    def rebuilt(spans_: Column) -> Column:
        ends = lambda i: F.when(i > 0, F.get(spans_, i - 1)["end"]).otherwise(0)
        pieces = F.transform(spans_, lambda m, i: F.concat(F.substring(text, ends(i) + 1, m["start"] - ends(i)), F.lit("<"), m["kind"], F.lit(">")))
        last = F.coalesce(F.get(spans_, F.size(spans_) - 1)["end"], F.lit(0))
        return F.concat(F.array_join(pieces, ""), F.substring(text, last + 1, F.length(text)))

    new = _let(stay, lambda kept: _let(F.transform(kept, lambda k: F.col(out)[k]), rebuilt))
    return held.withColumn(text_col, F.when(text.isNull(), text).otherwise(new)).drop(out)
