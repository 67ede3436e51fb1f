"""PII: format-preserving Feistel pseudonyms, in SQL functions only.

Validated numbers and dates are replaced by others of the same format. A value
is split in two halves; in eight rounds, a keyed hash of one half is added to
the other, modulo its size. That permutes all values of the format, so equal
values get equal pseudonyms in all documents, different ones different ones,
and nobody without the key can tell which.

| kind | validated by | permuted |
|-|-|-|
| card number | Luhn, also beside other digits | all digits but the last, which is made to fit |
| IBAN | modulo 97 | letters and digits after the check digits, which are made to fit |
| IPv4 address | four numbers up to 255 | 32 bits |
| date | the calendar, 1800 to 2199 | the day among the 400 years |
| social security number | no forbidden part | area, group and serial |
| phone number | 7 to 15 digits | the digits after the country code |
| e-mail address | the name's form | letters and digits of the local part |
| secret | a known form (fixed prefixes, 40 hex digits) | letters and digits behind the prefix |
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 8

# Forms of the kinds: fixed patterns, in the order in which they are tried.
FORMS = {
    # The host is one run of characters, as long as a host may be: a group for each label would be a call for each.
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-][A-Za-z0-9.-]{0,250}\.[A-Za-z]{2,63}",
    "secret": r"AKIA[0-9A-Z]{16}|[0-9a-f]{40}|password=[0-9A-Za-z]{8,64}",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
    "ipv4": r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}",
    "date": r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4}",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "phone": r"\+[0-9]{1,3}[ .-]?\([0-9]{2,4}\)[ .-]?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3}|\+[0-9]{1,3}(?:[ .-][0-9]{2,4}){2,5}|\+[0-9]{7,15}"
    r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}",
    "card": r"[0-9](?:[ -]?[0-9]){12,18}",
}
PATTERN = r"(?<![\w@]|[0-9][.-])(?:" + "|".join(FORMS.values()) + r")(?![\w@]|[.-][0-9])"


def _mixed(key: str, kind: str, number, half) -> Column:
    """A keyed hash in hex digits."""
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), number.cast("string"), half.cast("string"), F.lit(key)), 256)


def feistel(left: Column, right: Column, left_size, right_size, kind: str, key: str) -> Column:
    """Permute (left, right) among left_size * right_size pairs of numbers."""
    left_size, right_size = (F.lit(x).cast("long") if isinstance(x, int) else x.cast("long") for x in (left_size, right_size))

    def add(number, to, other, size):
        return F.pmod(to + F.conv(F.substring(_mixed(key, kind, number, other), 1, 13), 16, 10).cast("long"), size)

    def step(pair, number):
        new_left = add(number, pair["l"], pair["r"], left_size)
        new_right = add(number, pair["r"], pair["l"], right_size)
        turn = number % 2 == 0
        return F.struct(F.when(turn, new_left).otherwise(pair["l"]).alias("l"), F.when(turn, pair["r"]).otherwise(new_right).alias("r"))

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _let(value: Column, body) -> Column:
    """Name a value, so that it is worked out once where it is used often."""
    return F.transform(F.array(value), body)[0]


def permute_digits(digits: Column, kind: str, key: str) -> Column:
    """Permute strings of up to 30 digits among those of their length."""

    def body(d):
        n = F.length(d)
        half = (n / 2).cast("int")
        size = lambda k: F.pow(F.lit(10.0), k).cast("long")
        left, right = F.substring(d, F.lit(1), half), F.substring(d, half + 1, n)
        number = lambda x: F.coalesce(x.cast("long"), F.lit(0))
        pair = feistel(number(left), number(right), size(half), size(n - half), kind, key)
        join = lambda p: F.concat(F.lpad(p["l"].cast("string"), half, "0"), F.lpad(p["r"].cast("string"), n - half, "0"))
        return _let(pair, join)

    return _let(digits, body)


def permute_letters(text: Column, kind: str, key: str, letters: int = 26) -> Column:
    """Permute letters and digits within a to z (or the first ``letters`` of it), A to Z and 0 to 9; other characters stay."""

    def shifted(c, by):
        code = F.ascii(c)
        move = lambda first, n: F.chr(F.lit(first) + (code - first + by) % n)
        return (
            F.when(c.rlike("^[a-z]$"), move(97, letters)).when(c.rlike("^[A-Z]$"), move(65, 26)).when(c.rlike("^[0-9]$"), move(48, 10)).otherwise(c)
        )

    def half_shifted(half, pad):
        by = lambda j: F.conv(F.substring(pad, 2 * F.pmod(j - 1, F.lit(32)) + 1, F.lit(2)), 16, 10).cast("int")
        places = F.when(F.length(half) > 0, F.sequence(F.lit(1), F.length(half))).otherwise(F.array().cast("array<int>"))
        return F.array_join(F.transform(places, lambda j: shifted(F.substring(half, j, F.lit(1)), by(j))), "")

    def step(pair, number):
        new_left = _let(_mixed(key, kind, number, pair["r"]), lambda pad: half_shifted(pair["l"], pad))
        new_right = _let(_mixed(key, kind, number, pair["l"]), lambda pad: half_shifted(pair["r"], pad))
        turn = number % 2 == 0
        return F.struct(F.when(turn, new_left).otherwise(pair["l"]).alias("l"), F.when(turn, pair["r"]).otherwise(new_right).alias("r"))

    def body(s):
        half = (F.length(s) / 2).cast("int")
        start = F.struct(F.substring(s, F.lit(1), half).alias("l"), F.substring(s, half + 1, F.length(s)).alias("r"))
        pair = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)
        return _let(pair, lambda p: F.concat(p["l"], p["r"]))

    return _let(text, body)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refilled(value: Column, new: Column, what: str = "[^0-9]") -> Column:
    """The new characters, with the separators of the old value."""

    def step(state, c):
        keep = c.rlike(what)
        return F.struct(
            F.concat(state["out"], F.when(keep, c).otherwise(F.substring(new, state["at"], F.lit(1)))).alias("out"),
            (state["at"] + F.when(keep, 0).otherwise(1)).alias("at"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    return F.aggregate(F.split(value, ""), start, step)["out"]


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum: zero modulo ten for valid numbers."""

    def add(total, place):
        d = F.substring(digits, -place, F.lit(1)).cast("int")
        return total + F.when(place % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def _valid_part(value: Column, is_valid, make, inner: bool) -> Column:
    """``value`` with the longest valid part between separators replaced by ``make`` of it; null if none is valid.

    A pattern takes neighbouring numbers along, such as a year or a check number. Parts
    begin at the start or, if ``inner``, behind any separator.
    """
    places = F.sequence(F.lit(1), F.length(value))
    borders = F.filter(places, lambda i: F.substring(value, i, F.lit(1)).isin(" ", "-"))
    starts = F.concat(F.array(F.lit(1)), F.transform(borders, lambda i: i + 1)) if inner else F.array(F.lit(1))
    ends = F.concat(F.transform(borders, lambda i: i - 1), F.array(F.length(value)))
    parts = F.flatten(F.transform(starts, lambda a: F.transform(ends, lambda b: F.struct((a - b - 1).alias("less"), a.alias("start")))))
    text = lambda p: F.substring(value, p["start"], -p["less"])
    best = F.get(F.filter(F.array_sort(parts), lambda p: (p["less"] < 0) & F.coalesce(is_valid(text(p)), F.lit(False))), F.lit(0))

    def replaced(p):
        new = make(text(p))
        return F.concat(F.substring(value, F.lit(1), p["start"] - 1), new, F.substring(value, p["start"] - p["less"], F.length(value)))

    return _let(best, lambda p: F.when(p.isNotNull(), replaced(p)))


def _card(value: Column, key: str) -> Column:
    def is_valid(part):
        return _let(_digits(part), lambda d: F.when(F.length(d).between(13, 19), luhn_sum(d) % 10 == 0))

    def make(part):
        def whole(front):
            missing = F.pmod(10 - luhn_sum(F.concat(front, F.lit("0"))), F.lit(10))
            return _refilled(part, F.concat(front, missing.cast("string")))

        return _let(_digits(part), lambda d: _let(permute_digits(F.substring(d, F.lit(1), F.length(d) - 1), "card", key), whole))

    return _valid_part(value, is_valid, make, inner=True)


def _mod97(text: Column) -> Column:
    def add(total, c):
        n = F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return (total * F.when(n > 9, 100).otherwise(10) + n) % 97

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def _iban(value: Column, key: str) -> Column:
    plain = lambda part: F.regexp_replace(part, " ", "")
    rest = lambda s: F.substring(s, F.lit(5), F.length(s))

    def is_valid(part):
        check = lambda s: (F.length(s) >= 15) & (F.length(s) <= 34) & (_mod97(F.concat(rest(s), F.substring(s, 1, 4))) == 1)
        return _let(plain(part), check)

    def make(part):
        def body(s):
            land = F.substring(s, 1, 2)

            def whole(new):
                fits = F.lpad((98 - _mod97(F.concat(new, land, F.lit("00")))).cast("string"), 2, "0")
                return _refilled(part, F.concat(land, fits, new), "[ ]")

            return _let(permute_letters(rest(s), "iban", key), whole)

        return _let(plain(part), body)

    return _valid_part(value, is_valid, make, inner=False)


def _ipv4(value: Column, key: str) -> Column:
    def body(parts):
        n = lambda i: parts[i].cast("int")
        pair = feistel(n(0) * 256 + n(1), n(2) * 256 + n(3), 65536, 65536, "ipv4", key)
        text = lambda p: F.concat_ws(".", *[x.cast("string") for h in ("l", "r") for x in ((p[h] / 256).cast("int"), p[h] % 256)])
        return F.when((n(0) < 256) & (n(1) < 256) & (n(2) < 256) & (n(3) < 256), _let(pair, text))

    return _let(F.split(value, r"\."), body)


# 400 years have 146,097 days, whatever year they begin with: 189 * 773.
def _date(value: Column, key: str) -> Column:
    def body(shape):
        day = F.coalesce(
            F.try_to_timestamp(value, shape).cast("date"), F.try_to_timestamp(value, F.lit("MM/dd/yyyy")).cast("date")
        )
        form = F.when(F.try_to_timestamp(value, shape).isNull(), F.lit("MM/dd/yyyy")).otherwise(shape)

        def permuted(d):
            n = F.datediff(d, F.lit("1800-01-01").cast("date"))
            pair = feistel((n / 773).cast("int"), n % 773, 189, 773, "date", key)
            new = lambda p: F.date_add(F.lit("1800-01-01").cast("date"), (p["l"] * 773 + p["r"]).cast("int"))
            written = lambda x: F.when(form == "yyyy-MM-dd", F.date_format(x, "yyyy-MM-dd")).when(
                form == "dd.MM.yyyy", F.date_format(x, "dd.MM.yyyy")
            ).when(form == "dd/MM/yyyy", F.date_format(x, "dd/MM/yyyy")).otherwise(F.date_format(x, "MM/dd/yyyy"))
            return F.when((n >= 0) & (n < 189 * 773), written(_let(pair, new)))

        return _let(day, permuted)

    shape = F.when(value.rlike("-"), F.lit("yyyy-MM-dd")).when(value.rlike(r"\."), F.lit("dd.MM.yyyy")).otherwise(F.lit("dd/MM/yyyy"))
    return _let(shape, body)


# Areas are 1 to 899 without 666, groups 1 to 99, serials 1 to 9999.
def _ssn(value: Column, key: str) -> Column:
    def body(parts):
        area, group, serial = (parts[i].cast("int") for i in range(3))
        valid = (area >= 1) & (area <= 899) & (area != 666) & (group >= 1) & (serial >= 1)
        pair = feistel(area - F.when(area > 666, 2).otherwise(1), (group - 1) * 9999 + serial - 1, 898, 99 * 9999, "ssn", key)

        def text(p):
            new_area = p["l"] + F.when(p["l"] >= 665, 2).otherwise(1)
            padded = [(new_area, 3), ((p["r"] / 9999).cast("int") + 1, 2), (p["r"] % 9999 + 1, 4)]
            return F.concat_ws("-", *[F.lpad(x.cast("string"), n, "0") for x, n in padded])

        return F.when(valid, _let(pair, text))

    return _let(F.split(value, "-"), body)


def _phone(value: Column, key: str) -> Column:
    land = F.regexp_extract(value, r"^\+[0-9]{1,3}", 0)

    def body(d):
        rest = F.substring(value, F.length(land) + 1, F.length(value))
        new = F.concat(land, _refilled(rest, permute_digits(d, "phone", key)))
        return F.when((F.length(_digits(value)) >= 7) & (F.length(_digits(value)) <= 15), new)

    return _let(_digits(F.substring(value, F.length(land) + 1, F.length(value))), body)


def _email(value: Column, key: str) -> Column:
    name, host = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    return F.when(~F.contains(host, F.lit("..")), F.concat(permute_letters(name, "email", key), F.lit("@"), host))


def _secret(value: Column, key: str) -> Column:
    front = F.regexp_extract(value, "^(AKIA|password=)?", 0)
    rest = F.substring(value, F.length(front) + 1, F.length(value))
    hexes = value.rlike("^[0-9a-f]{40}$")
    return F.when(hexes, permute_letters(value, "hex", key, 6)).otherwise(F.concat(front, permute_letters(rest, "secret", key)))


KINDS = {"email": _email, "secret": _secret, "iban": _iban, "ipv4": _ipv4, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one value; null if it is of no kind, or not valid."""
    out = None
    for kind, make in KINDS.items():
        fits = value.rlike(f"^(?:{FORMS[kind]})$")
        out = F.when(fits, make(value, key)) if out is None else out.when(fits, make(value, key))
    return out


def pseudonymise(documents: DataFrame, key: str) -> DataFrame:
    """(doc_id, n_replaced, text) of each row of ``documents``, with pseudonyms in place of valid values.

    Null text stays null and has none. Texts without a valid value come out
    unchanged. The result depends on text and key only, so repeated rows come
    out alike, and rows without a doc_id as any other. Other columns are not
    looked at. Texts may be of any length: no pattern takes more of one than a value may have. Who has the key can tell the
    values again, so keep it apart from the texts.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = docs.withColumn("_found", F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)))
    pairs = F.transform("_found", lambda v: F.struct(v.alias("old"), pseudonym(v, key).alias("new")))
    found = found.withColumn("_pairs", F.when(F.size("_found") > 0, pairs))
    between = F.split("text", PATTERN, -1)
    whole = F.concat(
        F.array_join(F.zip_with(F.slice(between, F.lit(1), F.size("_pairs")), "_pairs", lambda b, p: F.concat(b, F.coalesce(p["new"], p["old"]))), ""),
        F.element_at(between, -1),
    )
    return found.select(
        "doc_id",
        F.coalesce(F.size(F.filter("_pairs", lambda p: p["new"].isNotNull())), F.lit(0)).cast("long").alias("n_replaced"),
        F.when(F.col("_pairs").isNull(), F.col("text")).otherwise(whole).alias("text"),
    )
