"""Format-preserving pseudonyms for personal numbers, dates and addresses.

What is found by pattern and passes its format's own test (check digit, number ranges, calendar) is permuted
within its format by an alternating Feistel network whose rounds are keyed by SHA-256. The permutation depends
on the key and the format only, so equal values get equal pseudonyms in every document, pseudonyms are valid
values, and who has the key can restore the originals. Everything happens within the row: no shuffle.

Formats: payment card numbers (13 to 19 digits, Luhn; the check digit is made anew), telephone numbers with
an area code of any three digits (in brackets, after a country code, or set off by a sign), IPv4 addresses, social security numbers, dates from 1900 to 2099 (ISO, or day first with dots), and
the letters and digits before the @ of mail addresses.

Defined results: a null text stays null, texts without findings stay as they are, values that fail their test
are no findings. A card number with other groups of digits beside it, 19 digits in all at most, is found in its printed forms;
where its pseudonym and those groups make up a further valid number, restoring may stop at that one. The text column is replaced in place; all other columns, whatever their names, are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: The patterns of the formats.
PATTERNS = {
    "mail": "(?<![\\p{L}\\p{N}._%+-])[\\p{L}\\p{N}._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\\.[A-Za-z0-9-]{1,63}){1,5}",
    "ip": f"(?<![0-9.])(?:{_OCTET}\\.){{3}}{_OCTET}(?![0-9]|\\.[0-9])",
    "date": "(?<![0-9])(?:(?:19|20)[0-9]{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])|(?:0[1-9]|[12][0-9]|3[01])\\.(?:0[1-9]|1[0-2])\\.(?:19|20)[0-9]{2})(?![0-9])",
    "ssn": "(?<![0-9-])(?!000|666)[0-8][0-9]{2}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
    "phone": "(?:\\+[0-9]{1,3}[ .-]?)?\\([0-9]{3}\\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])|\\+[0-9]{1,3}[ .-]?[0-9]{3}[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])|(?<![0-9])[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "card": "(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
}
#: How cards are printed; looked for where other groups of digits stand beside them.
PRINTED = ("[0-9]{13,19}", "[0-9]{4}([ -])[0-9]{4}\\2[0-9]{4}\\2[0-9]{4}", "[0-9]{4}([ -])[0-9]{4}\\2[0-9]{4}\\2[0-9]{4}\\2[0-9]{3}", "[0-9]{4}([ -])[0-9]{6}\\2[0-9]{4,5}")
ANY = "|".join(PATTERNS.values())


class Pseudonyms:
    """SQL of the permutations under one key."""

    def __init__(self, key: str, restore: bool = False):
        self.key = key.replace("\\", "\\\\").replace("'", "\\'")
        self.order = f"sequence({ROUNDS - 1}, 0, -1)" if restore else f"sequence(0, {ROUNDS - 1})"
        self.sign = "-" if restore else "+"

    def feistel(self, kind: str, left: str, right: str, a: str, b: str) -> str:
        """A struct (l, r) from numbers below a and b."""
        noise = lambda v: f"CAST(conv(substring(sha2(concat_ws('|', '{self.key}', {kind}, i, {v}), 256), 1, 15), 16, 10) AS BIGINT)"
        turn = f"IF(i % 2 = 0, named_struct('l', pmod(s.l {self.sign} {noise('s.r')} % {a}, {a}), 'r', s.r), named_struct('l', s.l, 'r', pmod(s.r {self.sign} {noise('s.l')} % {b}, {b})))"
        return f"aggregate({self.order}, named_struct('l', CAST({left} AS BIGINT), 'r', CAST({right} AS BIGINT)), (s, i) -> {turn})"

    def digits(self, kind: str, d: str) -> str:
        """A digit string of the same length, from one of up to 18 digits."""
        a, b = f"CAST(power(10, length({d}) DIV 2) AS BIGINT)", f"CAST(power(10, length({d}) - length({d}) DIV 2) AS BIGINT)"
        net = self.feistel(f"concat({kind}, length({d}))", f"IF(length({d}) < 2, '0', substring({d}, 1, length({d}) DIV 2))", f"substring({d}, length({d}) DIV 2 + 1)", a, b)
        return f"element_at(transform(array({net}), x -> concat(IF(length({d}) < 2, '', lpad(CAST(x.l AS STRING), length({d}) DIV 2, '0')), lpad(CAST(x.r AS STRING), length({d}) - length({d}) DIV 2, '0'))), 1)"

    @staticmethod
    def let(value: str, name: str, body: str) -> str:
        return f"element_at(transform(array({value}), {name} -> {body}), 1)"

    @staticmethod
    def refill(m: str, fresh: str, sign: str) -> str:
        """The characters of m, those of the class `sign` replaced in turn by the characters of `fresh`."""
        here = f"substring({m}, j, 1)"
        nth = f"length(regexp_replace(substring({m}, 1, j), '[^{sign}]', ''))"
        return f"array_join(transform(sequence(1, length({m})), j -> IF({here} RLIKE '[{sign}]', substring({fresh}, {nth}, 1), {here})), '')"

    def mail(self, m: str) -> str:
        local, rest = f"substring_index({m}, '@', 1)", f"concat('@', substring_index({m}, '@', -1))"
        plain = f"lower(regexp_replace({local}, '[^A-Za-z0-9]', ''))"
        # pieces of at most 12 signs, each a number to base 36 in two halves
        half, other = "length(c) DIV 2", "(length(c) - length(c) DIV 2)"
        number = lambda t: f"coalesce(CAST(conv(IF({t} = '', '0', {t}), 36, 10) AS BIGINT), 0L)"
        net = self.feistel("concat('mail', length(c), ':', k)", number(f"substring(c, 1, {half})"), number(f"substring(c, {half} + 1)"), f"CAST(power(36, {half}) AS BIGINT)", f"CAST(power(36, {other}) AS BIGINT)")
        show = lambda v, n: f"IF({n} = 0, '', lpad(lower(conv({v}, 10, 36)), {n}, '0'))"
        piece = self.let(net, "x", f"concat({show('x.l', half)}, {show('x.r', other)})")
        pieces = f"array_join(transform(regexp_extract_all(p, '.{{1,12}}', 0), (c, k) -> {piece}), '')"
        return f"concat({self.let(plain, 'p', self.let(pieces, 'fresh', self.refill(local, 'fresh', 'A-Za-z0-9')))}, {rest})"

    def ip(self, m: str) -> str:
        part = lambda i: f"CAST(split_part({m}, '.', {i}) AS BIGINT)"
        net = self.feistel("'ip'", f"{part(1)} * 256 + {part(2)}", f"{part(3)} * 256 + {part(4)}", "65536", "65536")
        return self.let(net, "x", "concat_ws('.', x.l DIV 256, x.l % 256, x.r DIV 256, x.r % 256)")

    def date(self, m: str) -> str:
        """The 73,049 days from 1900 to 2099 as pairs below 17 and 4,297."""
        form = f"IF({m} LIKE '%-%', 'yyyy-MM-dd', 'dd.MM.yyyy')"
        day = f"CAST(try_to_timestamp({m}, {form}) AS DATE)"
        net = self.feistel("'date'", "n DIV 4297", "n % 4297", "17", "4297")
        moved = self.let(f"datediff({day}, DATE'1900-01-01')", "n", self.let(net, "x", f"date_format(date_add(DATE'1900-01-01', CAST(x.l * 4297 + x.r AS INT)), {form})"))
        return f"IF({day} IS NULL, {m}, {moved})"

    def ssn(self, m: str) -> str:
        """Areas 001 to 899 without 666; groups and serials from 1."""
        area = f"CAST(split_part({m}, '-', 1) AS BIGINT)"
        low = f"(CAST(split_part({m}, '-', 2) AS BIGINT) - 1) * 9999 + CAST(split_part({m}, '-', 3) AS BIGINT) - 1"
        net = self.feistel("'ssn'", f"IF({area} > 666, {area} - 2, {area} - 1)", low, "898", "989901")
        out = "concat_ws('-', lpad(CAST(IF(x.l >= 665, x.l + 2, x.l + 1) AS STRING), 3, '0'), lpad(CAST(x.r DIV 9999 + 1 AS STRING), 2, '0'), lpad(CAST(x.r % 9999 + 1 AS STRING), 4, '0'))"
        return self.let(net, "x", out)

    def phone(self, m: str) -> str:
        """The ten national digits: areas and seven digits; the country code stays."""
        net = self.feistel("'phone'", "substring(d, length(d) - 9, 3)", "substring(d, length(d) - 6)", "1000", "10000000")
        fresh = self.let(net, "x", "concat(substring(d, 1, length(d) - 10), lpad(CAST(x.l AS STRING), 3, '0'), lpad(CAST(x.r AS STRING), 7, '0'))")
        return self.let(f"regexp_replace({m}, '[^0-9]', '')", "d", self.let(fresh, "fresh", self.refill(m, "fresh", "0-9")))

    @staticmethod
    def luhn(digits: str) -> str:
        """The Luhn sum of a digit string, doubling every second digit from the right."""
        one = f"CAST(substring({digits}, length({digits}) - q, 1) AS INT)"
        return f"aggregate(sequence(0, length({digits}) - 1), 0, (t, q) -> t + IF(q % 2 = 1, {one} * 2 - IF({one} > 4, 9, 0), {one}))"

    def valid_card(self, m: str) -> str:
        """The pseudonym of a card number, or what is no card number as it is."""
        fresh = self.let(self.digits("'card'", "substring(d, 1, length(d) - 1)"), "y", f"concat(y, CAST(pmod(10 - {self.luhn("concat(y, '0')")} % 10, 10) AS STRING))")
        changed = self.let(fresh, "fresh", self.refill(m, "fresh", "0-9"))
        return self.let(f"regexp_replace({m}, '[^0-9]', '')", "d", f"IF({self.luhn('d')} % 10 = 0, {changed}, {m})")

    def card(self, m: str) -> str:
        """The digits as one number; if that is none, the printed forms among their groups, also those that overlap."""
        found = [f"regexp_extract_all({m}, '(?<![0-9])(?=({p.replace(chr(92), chr(92) * 2)})(?![0-9]))', 1)" for p in PRINTED]
        printed = f"concat({', '.join(found)})"
        inside = f"aggregate({printed}, {m}, (t, c) -> replace(t, c, {self.valid_card('c')}))"
        return self.let(self.valid_card(m), "w", f"IF(w = {m}, {inside}, w)")

    def replaced(self, m: str) -> str:
        """The pseudonym of one finding."""
        tests = " ".join(f"WHEN {m} RLIKE '^(?:{PATTERNS[k].replace(chr(92), chr(92) * 2)})$' THEN {getattr(self, k)(m)}" for k in PATTERNS)
        return f"CASE {tests} ELSE {m} END"


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", restore: bool = False, count: str | None = None) -> DataFrame:
    """The rows with their texts' findings replaced; `count` names a column for the number of values changed."""
    text = F.col(f"`{text_col}`")
    found = F.when(text.rlike("[0-9]|@"), F.regexp_extract_all(text, F.lit(f"({ANY})"), F.lit(0))).otherwise(F.array().cast("array<string>"))
    rows = docs.withColumn("__found", F.coalesce(found, F.array().cast("array<string>")))
    rows = rows.withColumn("__new", F.expr(f"transform(__found, m -> {Pseudonyms(key, restore).replaced('m')})"))
    between = F.split(text, ANY, -1)
    joined = F.array_join(F.flatten(F.zip_with(between, F.col("__new"), lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    out = [F.when(F.size("__found") == 0, text).otherwise(joined).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c != count]
    changed = F.size(F.filter(F.arrays_zip(F.col("__found").alias("a"), F.col("__new").alias("b")), lambda x: x["a"] != x["b"])).cast("long")
    return rows.select(*out, *([changed.alias(count)] if count else []))


def same_values(column: Column) -> Column:
    """All findings of a text, as found."""
    return F.regexp_extract_all(column, F.lit(f"({ANY})"), F.lit(0))
