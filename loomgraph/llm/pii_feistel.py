"""Format-preserving pseudonyms for personal data by keyed Feistel permutations.

A value is found by its format and validated (card numbers by their check digit, account numbers modulo 97, dates by the
calendar, social-security numbers and addresses by the ranges of their parts, telephone numbers by their plan or form). It is then numbered within
all valid values of its format, the number is permuted by a balanced Feistel network keyed with BLAKE2b (walking on
until it falls into the format again), and written back into the same layout. Equal values get equal pseudonyms in every
document, whatever their punctuation; without the key they cannot be traced back.
"""

from __future__ import annotations

import bisect
import calendar
import datetime
import itertools
import re
from collections.abc import Callable
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.llm.batches import small_batches

ROUNDS = 8


class Feistel:
    """Keyed permutations of range(n) for any n; each tweak is a permutation of its own."""

    def __init__(self, key: bytes):
        self.key = key

    def __call__(self, x: int, n: int, tweak: str, back: bool = False) -> int:
        if not 0 <= x < n:
            raise ValueError(f"{x} is not below {n}")
        half = max(1, ((n - 1).bit_length() + 1) // 2)
        while True:
            x = self._once(x, half, f"{tweak}:{n}", back)
            if x < n:
                return x

    def _once(self, x: int, half: int, tweak: str, back: bool) -> int:
        mask, size = (1 << half) - 1, (half + 7) // 8
        left, right = x >> half, x & mask
        for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                left, right = right ^ self._round(left, r, size, tweak) & mask, left
            else:
                left, right = right, left ^ self._round(right, r, size, tweak) & mask
        return left << half | right

    def _round(self, half: int, r: int, size: int, tweak: str) -> int:
        out, block = b"", 0
        while len(out) < size:
            out += blake2b(half.to_bytes(size, "big") + bytes([r, block]), key=self.key, person=blake2b(tweak.encode(), digest_size=16).digest()).digest()
            block += 1
        return int.from_bytes(out[:size], "big")


def luhn(digits: str) -> int:
    """The sum whose last digit is 0 in valid card numbers."""
    return sum(int(d) if i % 2 == 0 else (2 * int(d) - 1) % 9 + 1 if d != "0" else 0 for i, d in enumerate(reversed(digits)))


def mod97(account: str) -> int:
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97


#: Lengths of account numbers by country, as registered.
ACCOUNT_LENGTHS = {
    x[:2]: int(x[2:])
    for x in (
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 "
        "GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 "
        "NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30"
    ).split()
}


def mask(address: int) -> bool:
    """Whether the 32 bits are ones, then zeros, as in network masks; either may be missing."""
    return not (~address & 0xFFFFFFFF) & ((~address & 0xFFFFFFFF) + 1)


def relaid(layout: str, digits: str, kind: str = "0-9") -> str:
    """digits put into the places of the layout's own characters of that kind."""
    it = iter(digits)
    return re.sub(f"[{kind}]", lambda _: next(it), layout)


class Pseudonyms:
    """Replaces personal data in texts. ``found`` is called with kind, start and end of each."""

    #: Formats by kind, tried in this order at each place.
    FORMATS = {
        "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}",
        "iban": r"(?<![A-Za-z0-9])(?:[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?|[a-z]{2}[0-9]{2}(?: ?[a-z0-9]{4}){2,7}(?: ?[a-z0-9]{1,3})?)(?![A-Za-z0-9])",
        "date": r"(?<![0-9.,/-])(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9/-]|\.[0-9])",
        "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
        "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])|(?<![0-9A-Za-z+])\+[0-9]{8,15}(?![0-9])|(?<![0-9A-Za-z+/.-])0[0-9]{2,4}/[0-9]{5,9}(?![0-9/])",
        "card": r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
    }

    def __init__(self, key: bytes):
        self.feistel = Feistel(key)
        # a card number may look like a telephone number to its first groups: the longer format goes first
        order = ["email", "iban", "date", "ssn", "ip", "card", "phone"]
        self.any = re.compile("|".join(f"(?P<{k}>{self.FORMATS[k]})" for k in order))
        self.may = re.compile("[0-9@]")
        self.alone = {k: re.compile(v) for k, v in self.FORMATS.items()}
        self.order = order

    def __call__(self, text: str, found: Callable[[str, int, int], None] = lambda *_: None) -> str:
        if not self.may.search(text):
            return text
        out, at = [], 0
        m = self.any.search(text)
        while m:
            kind, new, end = m.lastgroup, None, m.end()
            for k in self.order[self.order.index(kind) :]:
                n = m if k == kind else self.alone[k].match(text, m.start())
                v = next((v for v in self._readings(k, n[0]) if (new := getattr(self, f"_{k}")(v)) is not None), None) if n else None
                if v is not None:
                    kind, end = k, n.start() + len(v)
                    break
            if new is None:  # nothing valid begins here: go on after its first character
                end = m.start() + 1
                out.append(text[at:end])
            else:
                out += [text[at : m.start()], new]
                found(kind, m.start(), end)
            at = end
            m = self.any.search(text, at)
        return "".join(out) + text[at:]

    def _readings(self, kind: str, v: str) -> list[str]:
        """What a match may stand for, in the order to try. The tail of an account number may be the words after it: it
        is cut to the length of its country, or, where that is not known, before each of its spaces from the last on."""
        if kind != "iban":
            return [v]
        cuts = [v[:i] for i in range(len(v) - 1, 0, -1) if v[i] == " "]
        size = ACCOUNT_LENGTHS.get(v[:2].upper())
        return [c for c in cuts if len(c.replace(" ", "")) == size] + [v] if size else [v, *cuts]

    def _digits(self, digits: str, tweak: str) -> str:
        return str(self.feistel(int(digits), 10 ** len(digits), tweak)).zfill(len(digits))

    def _letters(self, text: str, tweak: str) -> str:
        """Digits stay digits, letters stay letters of their case, all else stays; cases do not matter to the number."""
        n, x = 1, 0
        for c in text.lower():
            if c.isdigit():
                n, x = n * 10, x * 10 + int(c)
            elif "a" <= c <= "z":
                n, x = n * 26, x * 26 + ord(c) - 97
        x, out = self.feistel(x, n, tweak), []
        for c in reversed(text):
            if c.isdigit():
                x, d = divmod(x, 10)
                c = str(d)
            elif "a" <= c.lower() <= "z":
                x, d = divmod(x, 26)
                c = chr(d + (97 if c.islower() else 65))
            out.append(c)
        return "".join(reversed(out))

    def _email(self, v: str) -> str:
        name, _, domain = v.rpartition("@")
        return f"{self._letters(name, 'email')}@{domain}"

    def _iban(self, v: str) -> str | None:
        plain = v.replace(" ", "").upper()
        if not 15 <= len(plain) <= 34 or mod97(plain) != 1:
            return None
        body = self._letters(plain[4:], f"iban:{plain[:2]}")
        check = 98 - mod97(f"{plain[:2]}00{body}")
        new = f"{plain[:2]}{check:02d}{body}"
        return relaid(v, new.lower() if v[0].islower() else new, "A-Za-z0-9")

    def _card(self, v: str) -> str | None:
        d = re.sub("[ -]", "", v)
        if luhn(d) % 10 or len(set(d)) == 1:
            return None
        body = d[0] + self._digits(d[1:-1], f"card:{d[0]}")
        return relaid(v, body + str(-luhn(body + "0") % 10))

    def _ip(self, v: str) -> str | None:
        """Host addresses stay host addresses, those that begin with 0 or 224 and up stay such. Masks stay as they are."""
        parts = v.split(".")
        if any(int(p) > 255 or str(int(p)) != p for p in parts):
            return None
        x = int.from_bytes(map(int, parts), "big")
        if 1 <= int(parts[0]) <= 223:
            x = self.feistel(x - (1 << 24), 223 << 24, "ip") + (1 << 24)
        else:
            if mask(x):
                return None
            low = 1 << 24  # numbered on: 0.*, then 224.* to 255.*
            while True:
                x = self.feistel(x if x < low else x - (223 << 24), 33 << 24, "ip:reserved")
                x = x if x < low else x + (223 << 24)
                if not mask(x):
                    break
        return ".".join(map(str, x.to_bytes(4, "big")))

    def _ssn(self, v: str) -> str | None:
        a, b, c = map(int, v.split("-"))
        if a in (0, 666) or a >= 900 or not b or not c:
            return None
        x = self.feistel(((a - 1 - (a > 666)) * 99 + b - 1) * 9999 + c - 1, 898 * 99 * 9999, "ssn")
        x, c = divmod(x, 9999)
        a, b = divmod(x, 99)
        return f"{a + 1 + (a >= 665):03d}-{b + 1:02d}-{c + 1:04d}"

    def _phone(self, v: str) -> str | None:
        d = re.sub("[^0-9]", "", v)
        plus, country = v[0] == "+", ""
        if len(d) == 11 and d[0] == "1" or len(d) == 10 and not plus:
            country, d = d[:-10], d[-10:]
            if d[0] == "0":
                return relaid(v, f"{country}0{self._digits(d[1:], 'phone:0')}")
            if d[0] == "1" or d[3] in "01":  # outside the plan: stays outside
                while True:
                    d = self._digits(d, "phone:unplanned")
                    if d[0] == "1" or d[0] != "0" and d[3] in "01":
                        return relaid(v, country + d)
            x = (int(d[:3]) - 200) * 800 + int(d[3:6]) - 200
            x, line = divmod(self.feistel(x * 10000 + int(d[6:]), 800 * 800 * 10000, "nanp"), 10000)
            return relaid(v, f"{country}{x // 800 + 200}{x % 800 + 200}{line:04d}")
        if not plus and d[0] == "0":  # national, with its trunk digit
            return relaid(v, "0" + self._digits(d[1:], "phone:0"))
        if v[0] == "(":
            return relaid(v, self._digits(d, "phone:area"))
        if not plus or not 8 <= len(d) <= 15:
            return None
        m = re.match(r"\+([0-9]{1,3})[ .(-]", v)
        country = m[1] if m else d[:2]
        return relaid(v, country + self._digits(d[len(country) :], f"phone:{country}"))

    #: Days after the twelfth before each month from January 1900 on, until December 2099.
    LATE = [0, *itertools.accumulate(calendar.monthrange(1900 + m // 12, m % 12 + 1)[1] - 12 for m in range(2400))]

    def _day(self, day: datetime.date) -> datetime.date:
        """The calendar day is permuted, so one day in two layouts stays one day. Days up to the twelfth and later ones are
        permuted each among themselves: only by the latter can days first and months first be told apart."""
        month = (day.year - 1900) * 12 + day.month - 1
        if day.day <= 12:
            month, d = divmod(self.feistel(month * 12 + day.day - 1, 2400 * 12, "date:early"), 12)
        else:
            x = self.feistel(self.LATE[month] + day.day - 13, self.LATE[-1], "date:late")
            month = bisect.bisect_right(self.LATE, x) - 1
            d = x - self.LATE[month] + 12
        return datetime.date(1900 + month // 12, month % 12 + 1, d + 1)

    def _date(self, v: str) -> str | None:
        """A day in its own layout; years, months and days without leading zeros come without."""
        a, b, c = map(int, re.split("[-./]", v))
        form = "{2:02d}/{1:02d}/{0:04d}"
        try:
            if "-" in v:
                day, form = datetime.date(a, b, c), "{0:04d}-{1:02d}-{2:02d}" if len(v) == 10 else "{0:04d}-{1}-{2}"
            elif "." in v:
                day, form = datetime.date(c, b, a), "{2:02d}.{1:02d}.{0:04d}"
            elif a > 12:
                day = datetime.date(c, b, a)
            else:
                day, form = datetime.date(c, a, b), "{1:02d}/{2:02d}/{0:04d}"
        except ValueError:
            return None
        if not 1900 <= day.year <= 2099:
            return None
        day = self._day(day)
        return form.format(day.year, day.month, day.day)


@lru_cache(maxsize=4)
def pseudonyms_of(key: bytes) -> Pseudonyms:
    return Pseudonyms(key)


KINDS = tuple(Pseudonyms.FORMATS)
FOUND = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def pseudonymised(docs: DataFrame, key: bytes) -> DataFrame:
    """docs (doc_id, text and any other columns) with the text's personal data replaced, and ``found``: kind, start and
    end (code points of the original text) of each replaced value.

    A null text stays null and has an empty list, as has a text without personal data. Rows are handled alone; names of
    other columns are free but for ``found``, which is replaced.
    """
    def run(batches):
        replace = pseudonyms_of(key)
        out = pa.schema([("text", pa.string()), ("found", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))])
        for b in batches:
            texts, lists = [], []
            for text in b.column("text").to_pylist():
                lists.append([])
                texts.append(None if text is None else replace(text, lambda k, s, e, into=lists[-1]: into.append((k, s, e))))
            keep = [b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(texts, out.field(0).type), pa.array([[dict(zip(("kind", "start", "end"), x)) for x in f] for f in lists], out.field(1).type)], names=[*b.schema.names[:-1], "text", "found"])

    small_batches(docs.sparkSession)
    rest = [c for c in docs.columns if c not in ("text", "found")]
    # other columns travel as one struct: names with dots are no argument of an Arrow function
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in rest), *[F.lit(0).alias("_none")] * (not rest)).alias("_rest"), F.col("text").cast("string").alias("text"))
    made = T.StructType([*own.schema.fields, T.StructField("found", FOUND)])
    return own.mapInArrow(run, made).select(*["_rest.*"] * bool(rest), "text", "found")


def report(done: DataFrame) -> DataFrame:
    """doc_id, the new text, n_values and a count for each kind."""
    count = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return done.select("doc_id", "text", F.size("found").cast("long").alias("n_values"), *map(count, KINDS))
