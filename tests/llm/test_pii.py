import random
import re

from loomgraph.llm.pii_feistel import KINDS, Feistel, Pseudonyms, luhn, mod97, pseudonymised, report

KEY = b"test key"


def test_feistel_is_a_permutation():
    f = Feistel(KEY)
    for n in (1, 2, 3, 10, 97, 1000, 4097):
        image = [f(x, n, "t") for x in range(n)]
        assert sorted(image) == list(range(n))
        assert [f(y, n, "t", back=True) for y in image] == list(range(n))
    assert f(5, 10**300, "t", back=True) != 5 and f(f(5, 10**300, "t"), 10**300, "t", back=True) == 5
    assert [f(x, 1000, "t") for x in range(20)] != [Feistel(b"other")(x, 1000, "t") for x in range(20)]


def one(text):
    found = []
    return Pseudonyms(KEY)(text, lambda *x: found.append(x)), found


def test_formats_stay_valid():
    for text, kind, form in (
        ("Mail abC.12@mail7.example.com now", "email", r"Mail [a-z]{2}[A-Z]\.[0-9]{2}@mail7\.example\.com now"),
        ("x 4111 1111 1111 1111.", "card", r"x 4[0-9]{3} [0-9]{4} [0-9]{4} [0-9]{4}\."),
        ("x 4111111111111111", "card", r"x 4[0-9]{15}"),
        ("at 59.89.108.176, and", "ip", r"at [0-9]+\.[0-9]+\.[0-9]+\.[0-9]+, and"),
        ("call +1 (319) 555-5132 x", "phone", r"call \+1 \([2-9][0-9]{2}\) [2-9][0-9]{2}-[0-9]{4} x"),
        ("call +4930123456 x", "phone", r"call \+49[0-9]{8} x"),
        ("born 1984-02-29.", "date", r"born [0-9]{4}-[0-9]{2}-[0-9]{2}\."),
        ("am 29.02.1984.", "date", r"am [0-9]{2}\.[0-9]{2}\.[0-9]{4}\."),
        ("DE89 3704 0044 0532 0130 00", "iban", r"DE[0-9]{2} [0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4} [0-9]{2}"),
        ("no 078-05-1120", "ssn", r"no [0-9]{3}-[0-9]{2}-[0-9]{4}"),
    ):
        new, found = one(text)
        assert [k for k, _, _ in found] == [kind], (text, found)
        assert re.fullmatch(form, new) and new != text, (text, new)
        assert one(new)[1][0][0] == kind  # still valid in its format
    assert luhn(re.sub(r"\D", "", one("4111 1111 1111 1111")[0])) % 10 == 0
    assert mod97(one("DE89370400440532013000")[0]) == 1


def test_equal_values_stay_linked():
    p = Pseudonyms(KEY)
    digits = lambda t: re.sub(r"\D", "", p(t))
    assert digits("4111 1111 1111 1111") == digits("4111-1111-1111-1111") == digits("4111111111111111")
    assert digits("+1 (319) 555-5132")[1:] == digits("319-555-5132")
    y, m, d = p("1984-02-29").split("-")
    assert p("29.02.1984") == f"{d}.{m}.{y}"
    assert p("ab@x.org").split("@")[0].upper() == p("AB@x.org").split("@")[0]


def test_invalid_values_stay():
    for text in ("4111 1111 1111 1112", "300.1.1.1", "1984-02-30", "000-12-3456", "Version 2.0. and 3.1.4", "12345", "a@b", "@", "DE88370400440532013000", "0x12ab", "2024"):
        assert one(text) == (text, []), text


def test_account_numbers_before_other_words():
    for number, after in (
        ("ES9121000418450200051332", " BIC CAIXESBB"), ("AT61 1904 3002 3457 3201", " BIC X"), ("BE68 5390 0754 7034", " KBC 12"), ("BE68539007547034", " GEBABEBB"),
        ("SE45 5000 0000 0583 9825 7466", " A1 x"), ("CZ6508000000192000145399", " GIBACZPX 7"), ("DE89 3704 0044 0532 0130 00", " BIC X"), ("XX36 1904 3002 3457 3201", " BIC X"),
    ):
        assert mod97(number.replace(" ", "")) == 1, number
        new, found = one(f"to {number}{after}.")
        assert [x for x in found if x[0] == "iban"] == found == [("iban", 3, 3 + len(number))], (number, found)
        assert new.endswith(f"{after}.") and new.startswith(f"to {number[:2]}") and number not in new
        assert mod97(new[3 : 3 + len(number)].replace(" ", "")) == 1
    assert one("ES9021000418450200051332 BIC X")[1] == []


def test_numbers_outside_the_plan_and_reserved_addresses():
    for text, kind, form in (
        ("call +1 (017) 555-7713 x", "phone", r"call \+1 \(0[0-9]{2}\) [0-9]{3}-[0-9]{4} x"),
        ("call +1 (132) 555-1352.", "phone", r"call \+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}\."),
        ("call 319-055-5132 x", "phone", r"call [0-9]{3}-[0-9]{3}-[0-9]{4} x"),
        ("Tel. 030 1234567", "phone", r"Tel\. 0[0-9]{2} [0-9]{7}"),
        ("Tel. 0151 23456789", "phone", r"Tel\. 0[0-9]{3} [0-9]{8}"),
        ("Tel. (30) 123456", "phone", r"Tel\. \([0-9]{2}\) [0-9]{6}"),
        ("at 248.40.198.62 x", "ip", r"at (0|22[4-9]|2[3-5][0-9])(\.[0-9]+){3} x"),
        ("at 0.12.13.14 x", "ip", r"at (0|22[4-9]|2[3-5][0-9])(\.[0-9]+){3} x"),
    ):
        new, found = one(text)
        assert [k for k, _, _ in found] == [kind] and re.fullmatch(form, new) and new != text, (text, new, found)
        assert [k for k, _, _ in one(new)[1]] == [kind]
    digits = lambda t: re.sub(r"\D", "", one(t)[0])
    assert digits("+1 (017) 555-7713")[1:] == digits("017-555-7713") and digits("+1 (132) 555-1352")[1:] == digits("132 555 1352")
    images = {one(f"+1 (132) 555-{i:04d}")[0] for i in range(2000)} | {one(f"248.1.{i >> 8}.{i & 255}")[0] for i in range(2000)}
    assert len(images) == 4000  # still a permutation
    for text in ("255.255.255.0", "0.0.0.0", "10.000.000", "12 345 678", "4111 1111 1111 1112"):
        assert one(text) == (text, []), text


def test_many_values_and_junk():
    rng, p = random.Random(1), Pseudonyms(KEY)
    for _ in range(2000):
        t = "".join(rng.choice("0123456789.-+() @ab/") for _ in range(rng.randint(0, 60)))
        found = []
        new = p(t, lambda *x: found.append(x))
        assert all(a[2] <= b[1] for a, b in zip(found, found[1:]))
        assert (new == t) or found


def test_table(spark):
    docs = spark.createDataFrame([(1, "a@b.org", 9), (None, None, None), (2, "", 1), (1, "a@b.org", 9), (3, "x " * 50000 + "1.2.3.4", 0)], "doc_id long, text string, start int")
    rows = {(r.doc_id, r.n_values, r.text if r.text is None else r.text[-12:]) for r in report(pseudonymised(docs, KEY)).collect()}
    p = Pseudonyms(KEY)
    assert rows == {(1, 1, p("a@b.org")), (None, 0, None), (2, 0, ""), (3, 1, ("x " * 50 + p("1.2.3.4"))[-12:])}
    assert pseudonymised(docs, KEY).columns == ["doc_id", "start", "text", "found"]
    assert report(pseudonymised(docs.where("false"), KEY)).columns == ["doc_id", "text", "n_values", *(f"n_{k}" for k in KINDS)]


def test_one_day_one_pseudonym():
    import datetime

    p, seen = Pseudonyms(KEY), set()
    for n in range(1824):
        day = datetime.date(2015, 1, 1) + datetime.timedelta(n)
        y, m, d = p(f"{day:%Y-%m-%d}").split("-")
        seen.add((y, m, d))
        assert p(f"{day:%d.%m.%Y}") == f"{d}.{m}.{y}"
        assert p(f"{day:%d/%m/%Y}" if day.day > 12 else f"{day:%m/%d/%Y}") == (f"{d}/{m}/{y}" if day.day > 12 else f"{m}/{d}/{y}")
        assert p(f"{day.year}-{day.month}-{day.day}") == (f"{y}-{int(m)}-{int(d)}" if len(f"{day.month}{day.day}") < 4 else f"{y}-{m}-{d}")
        datetime.date(int(y), int(m), int(d))
    assert len(seen) == 1824
    everything = {p._day(datetime.date(1900, 1, 1) + datetime.timedelta(n)) for n in range(73049)}
    assert len(everything) == 73049 and max(everything) == datetime.date(2099, 12, 31)


def test_more_forms():
    for text, kind, form in (
        ("tel 030/1234567 x", "phone", r"tel 0[0-9]{2}/[0-9]{7} x"),
        ("tel 0171 1234567 x", "phone", r"tel 0[0-9]{3} [0-9]{7} x"),
        ("de89 3704 0044 0532 0130 00.", "iban", r"de[0-9]{2} [0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4} [0-9]{2}\."),
        ("on 2023-1-5,", "date", r"on [0-9]{4}-[0-9]{1,2}-[0-9]{1,2},"),
    ):
        new, found = one(text)
        assert [k for k, _, _ in found] == [kind] and re.fullmatch(form, new) and new != text, (text, new, found)


def test_table_by_rules_of_its_own(spark, small):
    """What is replaced, where, and how, checked without the class: positions, character classes, validity, and that equal
    values have equal pseudonyms and different values different ones."""
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    before = {r.doc_id: r.text for r in docs.collect()}
    kind_of = lambda c: "d" if c.isdigit() else "l" if c.islower() else "u" if c.isupper() else c
    pairs = {}
    for r in pseudonymised(docs, KEY).collect():
        old = before[r.doc_id]
        inside = {i for f in r.found for i in range(f.start, f.end)}
        cuts = [0, *(x for f in r.found for x in (f.start, f.end)), len(old)]
        kept = [re.escape(old[a:b]) for a, b in zip(cuts[::2], cuts[1::2])]
        new = re.fullmatch(r"(\S+?(?: [0-9()\-]\S*?)*?)".join(kept), r.text)
        assert new, (old, r.text)
        for f, b in zip(r.found, new.groups()):
            a = old[f.start : f.end]
            assert f.kind == "ip" or [*map(kind_of, a)] == [*map(kind_of, b)]
            plain = lambda t: t.lower() if "@" in t else re.sub(r"[^0-9A-Za-z]", "", t)
            if f.kind == "date" and "-" not in a:
                continue  # another order of the same numbers
            pairs.setdefault(f.kind, {}).setdefault(plain(a), set()).add(plain(b))
            if f.kind == "card":
                digits = [int(c) for c in plain(b)][::-1]
                assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0
            if f.kind == "ip":
                assert all(0 <= int(x) <= 255 for x in b.split("."))
        covered = lambda m: {*range(*m.span())} <= inside  # noqa: E731, B023
        assert all(map(covered, re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", old)))
        assert all(map(covered, re.finditer(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", old)))
        assert all(map(covered, re.finditer(r"\+[0-9]{1,3} \([2-9][0-9]{2}\) [2-9][0-9]{2}-[0-9]{4}(?![0-9])", old)))
    assert pairs and all(len(v) == 1 for kind in pairs.values() for v in kind.values())
    for kind in pairs.values():
        assert len({*map(str, kind.values())}) == len(kind)


def test_odd_column_names(spark):
    docs = spark.createDataFrame([(1, "a@b.org", 1, 2, 3)], "doc_id long, text string, `a b` int, `c.d` int, `found it` int")
    got = pseudonymised(docs, KEY)
    assert got.columns == ["doc_id", "a b", "c.d", "found it", "text", "found"] and got.first()["c.d"] == 2
