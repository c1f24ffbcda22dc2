"""Pseudonyms against a plain program of the same definition."""

import datetime as dt
import hashlib
import re

from visitloom.llm.pii import SHAPES, pseudonymise

ANY = re.compile(r"(?<![A-Za-z0-9])(?:" + "|".join(SHAPES.values()) + r")(?![A-Za-z0-9])")
DAY = dt.date(1900, 1, 1)


def permuted(kind, symbols, key):
    values, half = [v for v, _ in symbols], (len(symbols) + 1) // 2
    for r in range(8):
        first = r % 2 == 0
        other = ",".join(map(str, values[half:] if first else values[:half]))
        for i in range(half) if first else range(half, len(values)):
            seed = f"{key}|{kind}|{len(values)}|{r}|{other}|{i}"
            values[i] = (values[i] + int(hashlib.sha256(seed.encode()).hexdigest()[:12], 16)) % symbols[i][1]
    return values


def refilled(text, new):
    new = iter(new)
    return "".join(str(next(new)) if c.isdigit() else chr(next(new) + 97) if c.islower() else chr(next(new) + 65)
                   if c.isupper() else c for c in text)


def checksum(digits):
    return sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits)))


def a_date(text):
    for pattern, order in ((r"(\d{4})-(\d\d)-(\d\d)$", "ymd"), (r"(\d+)\.(\d+)\.(\d{4})$", "dmy"),
                           (r"(\d+)/(\d+)/(\d{4})$", "mdy"), (r"(\d+)/(\d+)/(\d{4})$", "dmy")):
        if match := re.match(pattern, text):
            part = dict(zip(order, map(int, match.groups())))
            try:
                return dt.date(part["y"], part["m"], part["d"]), order, match
            except ValueError:
                pass
    return None


def pseudonym(text, key):
    digits = [int(c) for c in text if c.isdigit()]
    if "@" in text:
        local, domain = text.split("@")
        symbols = [(int(c), 10) if c.isdigit() else (ord(c.lower()) - 97, 26) for c in local if c.isalnum()]
        return refilled(local, permuted("email", symbols, key)) + "@" + domain
    if re.fullmatch(r"\d{1,3}(\.\d{1,3}){3}", text):
        parts = text.split(".")
        if all(int(p) < 256 and str(int(p)) == p for p in parts):
            return ".".join(map(str, permuted("ip", [(int(p), 256) for p in parts], key)))
        return text
    if re.fullmatch(SHAPES["phone"], text):
        ten = digits[-10:]
        sizes = [(2 if d < 2 else 8) if i in (0, 3) else 10 for i, d in enumerate(ten)]
        new = permuted("phone", [(d - 2 * (m == 8), m) for d, m in zip(ten, sizes)], key)
        return refilled(text, digits[:-10] + [v + 2 * (m == 8) for v, m in zip(new, sizes)])
    if re.fullmatch(SHAPES["ssn"], text):
        area, group, serial = map(int, text.split("-"))
        if not (0 < area < 900 and area != 666 and group and serial):
            return text
        a, g, s = permuted("ssn", [(area - 1 - (area > 666), 898), (group - 1, 99), (serial - 1, 9999)], key)
        return f"{a + 1 + (a > 664):03}-{g + 1:02}-{s + 1:04}"
    if re.fullmatch(SHAPES["date"], text):
        if not (found := a_date(text)):
            return text
        day, order, match = found
        u, v = permuted("date", [((day - DAY).days // 229, 319), ((day - DAY).days % 229, 229)], key)
        new = DAY + dt.timedelta(u * 229 + v)
        part = {"y": new.year, "m": new.month, "d": new.day}
        padded = all(len(g) > 1 for g in match.groups())
        out = [f"{part[x]:04}" if x == "y" else f"{part[x]:02}" if padded else str(part[x]) for x in order]
        return ("-" if "-" in text else "." if "." in text else "/").join(out)
    if checksum(digits) % 10 == 0:
        new = permuted("card", [(d, 10) for d in digits[:-1]], key)
        return refilled(text, [*new, -checksum([*new, 0]) % 10])
    return text


def pseudonymised(text, key):
    return text and ANY.sub(lambda m: pseudonym(m.group(), key), text)


TEXTS = [
    "call +1 (988) 555-2485 or 988-555-2485, 156.555.0186, card 4041894974608795, 4041-8949-7460-8795; ip 42.144.35.254",
    "999.1.1.1 01.2.3.4 1.2.3.4.5 v1.2.3.4 0.0.0.0 255.255.255.255 mail Hsr.29@mail5.example.com. a@b.de x@y",
    "born 1984-02-29, 29.02.1984 or 2/29/1984; 31/1/2024, 1.3.2001, 31.02.2020, 1999-13-01, 01/02/1950, 2100-01-01",
    "123-45-6789 000-11-2222 666-12-3456 665-01-0001 667-01-0001 899-99-9999 900-10-1000",
    "1234567890123 4041894974608796 3782 822463 10005 12 4041894974608795 4041894974608795x é4041894974608795é",
    "", "no value", "4041894974608795", "\n42.144.35.254\n42.144.35.254",
]


def test_against_a_plain_program(make_documents):
    documents = make_documents(*enumerate([*TEXTS, None, "x 42.144.35.254 " * 2000]), (None, "1984-02-29"), (3, TEXTS[3]))
    got = pseudonymise(documents, "key").collect()
    assert [(r["doc_id"], r["text"]) for r in got] == [(r["doc_id"], pseudonymised(r["text"], "key")) for r in documents.collect()]
    assert got[0].asDict().keys() == set(documents.columns) | {"pii"}


def test_valid_linked_and_different(make_documents):
    cards = [f"{n:015}" for n in range(400_000_000_000_000, 400_000_000_000_300)]
    cards = [c + str(-checksum([*map(int, c), 0]) % 10) for c in cards]
    rows = pseudonymise(make_documents((1, " ".join(cards)), (2, " ".join(cards))), "key").collect()
    new = rows[0]["text"].split()
    assert rows[0]["text"] == rows[1]["text"] and len(set(new)) == len(cards)
    assert all(checksum(list(map(int, c))) % 10 == 0 and len(c) == 16 for c in new)
    days = [(DAY + dt.timedelta(n)).isoformat() for n in range(0, 73_049, 97)]
    (row,) = pseudonymise(make_documents((1, " ".join(days))), "key").collect()
    assert len(set(row["text"].split())) == len(days) and row["pii"][0]["kind"] == "date"


def test_a_date_is_one_in_all_formats_and_keys_differ(make_documents):
    documents = make_documents((1, "1984-02-09 09.02.1984 02/09/1984"))
    (row,) = pseudonymise(documents, "key").collect()
    iso, dotted, slashed = row["text"].split()
    y, m, d = iso.split("-")
    assert dotted == f"{d}.{m}.{y}" and slashed == f"{m}/{d}/{y}"
    assert pseudonymise(documents, "it's\\another").first()["text"] != row["text"]


def test_names_and_empty_table(spark, make_documents):
    documents = make_documents().withColumnRenamed("words", "pii")
    assert pseudonymise(documents, "key").count() == 0
    assert "pii_" in pseudonymise(documents, "key").columns
