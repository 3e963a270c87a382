"""Pseudonyms and the classifier, recomputed by other code: plain Python integers and dictionaries."""

import hashlib
import math
import random
import re
from datetime import date, timedelta

import pandas as pd
import xxhash
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from txnguard.llm import pii, toxicity

KEY, MASK = "a key", (1 << 64) - 1


def noise(kind, i, *parts):
    told = "|".join([KEY, kind, str(i), *map(str, parts)])
    return int(hashlib.sha256(told.encode()).hexdigest()[:15], 16)


def number(x, a, b, kind):
    left, right = divmod(x, b)
    for i in range(10):
        if i % 2 == 0:
            left = (left + noise(kind, i, right)) % a
        else:
            right = (right + noise(kind, i, left)) % b
    return left * b + right


def letters(s, kind):
    def moved(half, other, i):
        out = ""
        for p, c in enumerate(half, 1):
            for first, size in (("0", 10), ("a", 26), ("A", 26)):
                if 0 <= ord(c) - ord(first) < size:
                    c = chr(ord(first) + (ord(c) - ord(first) + noise(kind, i, p, other)) % size)
                    break
            out += c
        return out
    left, right = s[:len(s) // 2], s[len(s) // 2:]
    for i in range(10):
        if i % 2 == 0:
            left = moved(left, right, i)
        else:
            right = moved(right, left, i)
    return left + right


def refilled(form, new, what=r"\d"):
    fresh = iter(new)
    return re.sub(what, lambda m: next(fresh), form)


def luhn(body):
    total = sum(sum(divmod(int(c) * (2 - i % 2), 10)) for i, c in enumerate(reversed(body)))
    return str(-total % 10)


def card(v):
    digits = re.sub(r"\D", "", v)
    body = digits[0] + letters(digits[1:-1], "card")
    return refilled(v, body + luhn(body))


def ssn(v):
    area, group, serial = map(int, v.split("-"))
    x = number(((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1, 898 * 99, 9999,
               "ssn")
    there, rest = divmod(x, 99 * 9999)
    return f"{there + 1 + (there >= 665):03d}-{rest // 9999 + 1:02d}-{rest % 9999 + 1:04d}"


def phone(v):
    digits = re.sub(r"\D", "", v)
    ten = digits[-10:]
    x = number((int(ten[:3]) - 200) * 8_000_000 + (int(ten[3:6]) - 200) * 10_000 + int(ten[6:]),
               80_000, 80_000, "phone")
    return refilled(v, digits[:-10] + f"{x // 8_000_000 + 200}{x // 10_000 % 800 + 200}"
                    f"{x % 10_000:04d}")


def ip(v):
    a, b, c, d = map(int, v.split("."))
    x = number(((a * 256 + b) * 256 + c) * 256 + d, 1 << 16, 1 << 16, "ip")
    return ".".join(str(x >> s & 255) for s in (24, 16, 8, 0))


def day(v):
    first = date(1700, 1, 1)
    x = number((date.fromisoformat(v) - first).days, 27, 5411, "date")
    return (first + timedelta(days=x)).isoformat()


def email(v):
    local, _, domain = v.partition("@")
    return refilled(local, letters(re.sub("[^A-Za-z0-9]", "", local), "email"),
                    "[A-Za-z0-9]") + "@" + domain


def abroad(v):
    digits = re.sub(r"\D", "", v)
    return refilled(v, digits[:2] + letters(digits[2:], "abroad"))


def iban(v):
    def mod97(s):
        return int("".join(str(int(c, 36)) for c in s)) % 97
    plain = v.replace(" ", "")
    new = letters(plain[4:], "iban")
    return refilled(v, plain[:2] + f"{98 - mod97(new + plain[:2] + '00'):02d}" + new, "[A-Z0-9]")


def test_pseudonyms(spark):
    rng = random.Random(8)

    def digits(n):
        return "".join(rng.choice("0123456789") for _ in range(n))
    cases = []
    for _ in range(12):
        body = "4" + digits(14)
        plain = body + luhn(body)
        cases += [(card, plain), (card, " ".join(plain[i:i + 4] for i in range(0, 16, 4)))]
        cases.append((ssn, f"{rng.randrange(1, 666):03d}-{rng.randrange(1, 100):02d}-"
                           f"{rng.randrange(1, 10_000):04d}"))
        area, exchange = rng.randrange(200, 1000), rng.randrange(200, 1000)
        cases.append((phone, f"({area}) {exchange}-{digits(4)}"))
        cases.append((phone, f"+1 {area}.{exchange}.{digits(4)}"))
        cases.append((ip, ".".join(str(rng.randrange(256)) for _ in range(4))))
        cases.append((day, str(date(1700, 1, 1) + timedelta(days=rng.randrange(146_097)))))
        cases.append((email, f"{rng.choice('aZq')}{digits(3)}.x-Y_{digits(2)}b@host.example.org"))
        cases.append((abroad, f"+44 20 {digits(4)} {digits(4)}"))
    cases += [(iban, "DE89370400440532013000"), (iban, "GB82 WEST 1234 5698 7654 32"),
              (iban, "ES9121000418450200051332")]
    df = spark.createDataFrame([(i, f"see {v}, then") for i, (_, v) in enumerate(cases)],
                               "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.pseudonymise(df, KEY).collect()}
    for i, (kind, v) in enumerate(cases):
        assert got[i] == f"see {kind(v)}, then", (kind.__name__, v)


VALUES = [xxhash.xxh64_intdigest(bytes([b]), 13) for b in range(256)]
M1, M2, M3 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0xC2B2AE3D27D4EB4F


def hashed(word, size):
    """The hash of a word's bytes; `size` is what the mixing adds."""
    h = sum(VALUES[b] * (pow(M1, i, 1 << 64) if i else 1) for i, b in enumerate(word)) + size * M2
    h &= MASK
    h = (h ^ (h >> 32)) * M2 & MASK
    return h ^ (h >> 29)


def numbers(text, p):
    words = "".join(c.lower() if "A" <= c <= "Z" else c if c.isascii() and c.isalnum()
                    or ord(c) > 127 else " " for c in text or "").split()
    h = [hashed(w.encode(), len(w.encode())) for w in words]
    stems = [hashed(w[:p.stem].encode(), 0) for w in words]
    marks = h + [s * M1 & MASK for s in stems]
    marks += [((a * M1 & MASK) ^ b) * M3 & MASK for a, b in zip(h, h[1:])]
    marks += [((a * M3 & MASK) ^ b) * M1 & MASK for a, b in zip(h, h[2:])]
    return sorted({0} | {(m >> (64 - p.bits)) or 1 for m in marks})


def test_classifier(spark):
    """Features and FTRL updates by dictionaries give the operator's weights and scores."""
    p = toxicity.ToxicityParams(max_train=40, epochs=2, bits=14)
    docs = pd.read_parquet(f"{SF_SMALL}/documents.parquet")[["doc_id", "text"]].head(120)
    labels = pd.read_parquet(f"{SF_SMALL}/labels.parquet")[["doc_id", "toxic"]]
    d, lab = spark.createDataFrame(docs), spark.createDataFrame(labels)
    model = toxicity.fit(d, lab, p)
    got = {r.doc_id: (r.score, r.predicted) for r in toxicity.score(d, model, p).collect()}

    import zlib
    text = dict(zip(docs["doc_id"], docs["text"]))
    known = {i: int(y) for i, y in zip(labels["doc_id"], labels["toxic"])
             if i in text and zlib.crc32(str(i).encode()) % 5}
    hashes = (spark.createDataFrame([(int(i), e) for i in labels["doc_id"]
                                     for e in range(1, p.epochs + 1)], "i long, e int")
              .select("i", "e", F.xxhash64("i").alias("one"), F.xxhash64("i", "e").alias("h")))
    order = {(r.i, r.e): (r.one, r.h) for r in hashes.collect()}
    usable = [i for i in labels["doc_id"].tolist() if zlib.crc32(str(i).encode()) % 5]
    chosen = {i for i in sorted(set(usable), key=lambda i: (order[i, 1][0], i))[:p.max_train]}
    z, n, start = {}, {}, math.log(p.prior / (1 - p.prior))

    def weight(i):
        if abs(z.get(i, 0.0)) <= p.l1:
            return 0.0
        return (math.copysign(p.l1, z[i]) - z[i]) / ((p.beta + math.sqrt(n[i])) / p.alpha + p.l2)

    def chance(marks):
        x = start + sum(weight(i) for i in marks)
        return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))
    for e in range(1, p.epochs + 1):
        for doc in sorted((i for i in known if i in chosen), key=lambda i: (order[i, e][1], i)):
            marks = numbers(text[doc], p)
            g = chance(marks) - known[doc]
            for i, w in [(i, weight(i)) for i in marks]:
                before = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) \
                    / p.alpha * w
                n[i] = before + g * g
    assert {i for i in z if weight(i)} == set(model[0].tolist())
    for doc, t in text.items():
        want = chance(numbers(t, p))
        assert abs(got[doc][0] - want) < 1e-9 and got[doc][1] == (want >= 0.5)
