import hashlib
import random
import re
import time

import pytest

from gridpanel.llm import pii

#: the contract's patterns as they stand
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = "".join(c for c in m[0] if c in "0123456789")
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")) or kind == "phone" and not 9 <= len(digits) <= 15 \
                    or kind == "card" and not (13 <= len(digits) <= 19 and plain_luhn(digits)):
                continue
            out.append((kind, *m.span()))
    return out


IBAN, CARD = "DE89370400440532013000", "4111 1111 1111 1111"
TEXTS = [
    "a@b.c", "a@b", "a@b.c@d.e", "@b.c x@y.z.", " @b.c@d.e", "%+@-.-", "a@b..c", "é.x@ñ.es", "a@b.c-@d.e.f", "x" * 300 + "@a.b", "1.2.3.4", "1.2.3.4.5.6.7.8",
    "256.1.1.1", "000255.0.0.00", "1.2.3", "1.2.3.4.5", "999.1.2.3.4.5.6.7", "1" * 40 + ".1.1.1", CARD, CARD.replace(" ", "-"), "4111  1111 1111 1111",
    "4111 1111 1111 1112", "0" * 13, "0" * 19, "0" * 20, "5 " * 13, "12 4111111111111111", "+1 (743) 555-3824", "+1-", "+12", "+1 2 3 4 5 6 7 8 9", "++1 234567890+",
    "+123456789012345", "+1234567890123456", "+1 234567890 ( - .", "٤٢.1.1.1 ٤", "+١23456789", f"IBAN {IBAN}", IBAN, f"{IBAN[:4]} 3704 0044 0532 0130 00",
    "BE68 5390 0754 7034 MEHR", IBAN[:-1] + "1", "ssn 078-05-1120", "078-05-1120", "ssn: 666-05-1120 or 900-10-1000", "routing 021000021", "021000021", "aba 021000022",
    "call (743) 555-3824", "743 555 3824", "order 743-555-3824 call", "serial ssn 078-05-1120", "tel +1 (743) 555-3824 fax 743.555.3824", "version 1.2.3.4 ip"]


def plain(text):
    """Reported spans with scores, each added span held against every base span."""
    text = text or ""
    found = [(pii.KINDS.index(k), s, e) for k, s, e in base(text)]
    found += [a for a in pii.added_spans(text) if not any(s < a[2] and a[1] < e for _, s, e in found)]
    scored = [(*f, pii.score(text, *f)) for f in found]
    return sorted(f for f in scored if f[0] < 4 or f[3] >= pii.REPORT)


def shown(found):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e, _ in found)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(6)
    bits = ["a", "b.c", "@", "@x", ".", ".com", "1", "23", "4111111111111111", "+1", "+", " ", "-", "(", ")", "\n", "é", "255", "256", "0", "555", "call ", IBAN, " order ", "078-05-1120"]
    return TEXTS + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(1500)]


def test_spans_are_those_of_the_patterns(texts):
    for t in texts:
        assert pii.find(t) == plain(t), t


def test_digest(spark, docs, odd_texts, texts):
    rows = list(enumerate(odd_texts + texts[:300])) + [(None, "a@b.c"), (3, "a@b.c"), (3, "a@b.c")]
    got = pii.pii_digest(docs(rows).repartition(5))
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "scores"]
    want = []
    for i, t in rows:
        f = plain(t)
        counts = [sum(k == n for k, *_ in f) for n in range(4)]
        want.append((i, *counts, hashlib.sha256(shown([s for s in f if s[0] < 4]).encode()).hexdigest(), shown(f), ",".join(str(s[3]) for s in f)))
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)                # noqa: E731
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)
    assert pii.pii_digest(docs([])).count() == 0


def test_general_interface_and_redaction(spark, docs):
    df = docs([(1, "Mail a@b.c or 1.2.3.4"), (2, None), (3, ""), (4, f"card {CARD}x@y.z")]).repartition(2)
    found = {r["id"]: [(s["kind"], s["start"], s["stop"], s["score"]) for s in r["found"]] for r in pii.find_pii(df).collect()}
    assert found == {1: [("email", 5, 10, 90), ("ip", 14, 21, 60)], 2: [], 3: [], 4: [("email", 20, 29, 90), ("card", 5, 24, 100)]}
    out = pii.redact(df)
    assert out.schema == df.schema
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "Mail [EMAIL] or [IP]", 2: None, 3: "", 4: "card [CARD]"}
    assert {r["doc_id"]: r["text"] for r in pii.redact(df, least=80).collect()}[1] == "Mail [EMAIL] or 1.2.3.4"


def test_validators():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97(IBAN) and pii.mod97("GB82 WEST 1234 5698 7654 32") and not pii.mod97("GB83WEST12345698765432")
    assert pii.routing_sum("021000021") and not pii.routing_sum("021000022")
    assert shown(pii.find("IBAN BE68 5390 0754 7034 MEHR")) == "iban:5:24"


def test_context_moves_the_score():
    number = "078-05-1120"
    assert shown(pii.find(f"SSN {number}")) == "ssn:4:15"
    assert pii.find(number) == [] and pii.find(f"SSN {'x ' * 30}{number}") == []
    assert pii.find("x 1.2.3.4")[0][3] == 60 and pii.find("server 1.2.3.4")[0][3] == 100 and pii.find("version 1.2.3.4")[0][3] == 30


@pytest.mark.parametrize("piece", ["a", "1", "1.", "@a.b", "+1 ", "- ", "1 ", "a@", "AB12", "(", "4111111111111111 ", "1.2.3.4 call 743-555-3824 "])
def test_time_is_linear_in_the_text(piece):
    def seconds(n):
        text = piece * (n // len(piece))
        best = 9e9
        for _ in range(2):
            start = time.perf_counter()
            pii.find(text)
            best = min(best, time.perf_counter() - start)
        return best
    small = seconds(100_000)
    assert seconds(800_000) < 8 * small * 4 + 0.5
