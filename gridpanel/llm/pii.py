"""Personal data: regular expressions propose spans, checksums confirm them, nearby context words adjust the score.

Base kinds (``email``, ``ip``, ``card``, ``phone``) are reported wherever they
occur. Added kinds (``iban`` by mod-97, ``ssn``, ``routing`` by its weighted
sum, ``local_phone``) are reported where they meet no base span and their
score, from 0 to 100, reaches ``REPORT``: a number that means little alone
needs a word that says what it is within ``NEAR`` code points.

Every pattern is matched in time linear in the text: a match can only begin at
the start of its run of letters or digits, and an address is found by its
``@`` and then extended to the left.
"""
from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices

NEAR = 40
REPORT = 50
TEXT_BYTES = 16 << 20       # texts that a task turns into spans at a time

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "routing", "local_phone")
KINDS = BASE + ADDED
START = {"email": 90, "ip": 60, "card": 80, "phone": 70, "iban": 85, "ssn": 30, "routing": 15, "local_phone": 30}
UP, DOWN = 40, 30
#: words (without case) that speak for and against a kind
FOR = {"email": "e-?mail|contact|write", "ip": "ip|address|host|server", "card": "card|visa|mastercard|amex|payment|cvv|expir[a-z]*",
       "phone": "phone|tel|call|mobile|fax|cell", "iban": "iban|account|bank|transfer", "ssn": "ssn|social security|social sec",
       "routing": "routing|aba|rtn", "local_phone": "phone|tel|call|mobile|fax|cell"}
AGAINST = {"email": "example", "ip": "version|release|build", "card": "order|tracking|invoice|isbn|serial", "phone": "order|serial",
           "iban": "serial", "ssn": "order|part|serial", "routing": "order|part|serial", "local_phone": "order|part|serial"}

EMAIL_END = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_START = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)\b", re.A)
SSN = re.compile(r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", re.A)
ROUTING = re.compile(r"\b[0-9]{9}\b", re.A)
LOCAL_PHONE = re.compile(r"\b[2-9][0-9]{2}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}\b", re.A)
_WORDS = {k: (re.compile(rf"\b(?:{FOR[k]})\b", re.A | re.I), re.compile(rf"\b(?:{AGAINST[k]})\b", re.A | re.I)) for k in KINDS}


# -- validators -------------------------------------------------------------------------------------------------------

def digits_of(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def luhn(digits: str) -> bool:
    """Sum of the digits, every second one from the right doubled and its own digits added, is a multiple of ten."""
    doubled = sum(int("0246813579"[int(d)]) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + doubled) % 10 == 0


def mod97(iban: str) -> bool:
    """The account number moved in front, letters as 10 to 35, leaves 1 when divided by 97."""
    compact = iban.replace(" ", "")
    return 15 <= len(compact) <= 34 and int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def routing_sum(digits: str) -> bool:
    return sum(int(d) * w for d, w in zip(digits, (3, 7, 1) * 3)) % 10 == 0 and digits.strip("0") != ""


def small_parts(address: str) -> bool:
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in (part.lstrip("0") for part in address.split(".")))


def issued_ssn(number: str) -> bool:
    area, group, serial = number.split("-")
    return area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000"


def _valid_iban(match: re.Match) -> tuple[int, int] | None:
    """The match, or its longest beginning at a group's end, that passes: a spaced number may run into the next words."""
    text = match[0]
    while text:
        if mod97(text):
            return match.start(), match.start() + len(text)
        text = text[:text.rindex(" ")] if " " in text else ""
    return None


# -- spans ------------------------------------------------------------------------------------------------------------

def emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in EMAIL_END.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in EMAIL_START:
            start -= 1
        if start < m.start():
            yield start, m.end()
            done = m.end()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(number of the kind, start, end) of the base kinds, in that order."""
    found = [(0, s, e) for s, e in emails(text)]
    found += [(1, *m.span()) for m in IP.finditer(text) if small_parts(m[0])]
    found += [(2, *m.span()) for m in CARD.finditer(text) if m.end() - m.start() >= 13 and 13 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
    found += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return found


def added_spans(text: str) -> list[tuple[int, int, int]]:
    found = [(4, *s) for s in map(_valid_iban, IBAN.finditer(text)) if s]
    found += [(5, *m.span()) for m in SSN.finditer(text) if issued_ssn(m[0])]
    found += [(6, *m.span()) for m in ROUTING.finditer(text) if routing_sum(m[0])]
    return found + [(7, *m.span()) for m in LOCAL_PHONE.finditer(text)]


def score(text: str, kind: int, start: int, end: int) -> int:
    """The kind's starting score, raised or lowered by words within ``NEAR`` code points before or after the span."""
    around = text[max(0, start - NEAR):start] + "\n" + text[end:end + NEAR]
    good, bad = _WORDS[KINDS[kind]]
    return max(0, min(100, START[KINDS[kind]] + UP * bool(good.search(around)) - DOWN * bool(bad.search(around))))


def find(text: str) -> list[tuple[int, int, int, int]]:
    """(number of the kind, start, end, score) of every reported span, by kind, then start."""
    base = base_spans(text)
    found = [(*s, score(text, *s)) for s in base]
    taken: list[list[int]] = []                     # what base spans cover, as disjoint intervals
    for _, s, e in sorted(base, key=lambda span: span[1:]):
        if taken and s < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], e)
        else:
            taken.append([s, e])
    for k, s, e in added_spans(text):
        before = bisect.bisect_left(taken, [e])     # intervals that begin before the span's end
        if not (before and taken[before - 1][1] > s) and (points := score(text, k, s, e)) >= REPORT:
            found.append((k, s, e, points))
    return sorted(found)


# -- over tables ------------------------------------------------------------------------------------------------------

def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, found)``: the spans of every row as array<struct<kind, start, stop, score>>, by kind, then start.

    Starts and stops count code points, the stop is exclusive. A null or empty
    text has none. Rows keep their number, also repeated ones and those
    without an id; other columns are ignored."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("t"))
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("score", pa.int32())])

    def task(batches):
        for batch in batches:
            for part in slices(batch, "t", TEXT_BYTES):
                found = [[{"kind": KINDS[k], "start": s, "stop": e, "score": p} for k, s, e, p in find(t or "")]
                         for t in part.column("t").to_pylist()]
                yield pa.record_batch({"id": part.column("id"), "found": pa.array(found, pa.list_(span))})

    return rows.mapInArrow(task, f"id {dict(rows.dtypes)['id']}, found array<struct<kind:string,start:long,stop:long,score:int>>")


def pii_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores (of the spans, in percent) of every row."""
    rows = docs.select("doc_id", docs["text"].alias("t"))
    counted = [f"n_{k}" for k in BASE]

    def task(batches):
        for batch in batches:
            for part in slices(batch, "t", TEXT_BYTES):
                found = [find(t or "") for t in part.column("t").to_pylist()]
                joined = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e, _ in spans)                # noqa: E731
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"),
                    **{c: pa.array([sum(s[0] == i for s in f) for f in found], pa.int64()) for i, c in enumerate(counted)},
                    "base_sha256": pa.array([hashlib.sha256(joined([s for s in f if s[0] < len(BASE)]).encode()).hexdigest() for f in found],
                                            pa.string()),
                    "spans": pa.array([joined(f) for f in found], pa.string()),
                    "scores": pa.array([",".join(str(s[3]) for s in f) for f in found], pa.string())})

    return rows.mapInArrow(task, f"doc_id {dict(rows.dtypes)['doc_id']}, {', '.join(c + ' long' for c in counted)}, "
                                 "base_sha256 string, spans string, scores string")


def redact(docs: DataFrame, text_col: str = "text", least: int = 0) -> DataFrame:
    """``docs`` with every reported span of score ``least`` or more replaced by its kind in brackets.

    Overlapping spans become one, named by the first. All rows and columns stay; a null text stays null."""
    at = docs.columns.index(text_col)

    def clean(text):
        if not text:
            return text
        out, done = [], 0
        for s, e, k in sorted((s, e, k) for k, s, e, p in find(text) if p >= least):
            if s >= done:
                out += [text[done:s], f"[{KINDS[k].upper()}]"]
            done = max(done, e)
        return "".join(out) + text[done:]

    def task(batches):
        for batch in batches:
            for part in slices(batch.rename_columns([str(i) for i in range(batch.num_columns)]), str(at), TEXT_BYTES):
                cols = part.columns
                cols[at] = pa.array([clean(t) for t in part.column(at).to_pylist()], part.column(at).type)
                yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return docs.mapInArrow(task, docs.schema)


def _located(kind: str, pattern: str, keep: str) -> str:
    """SQL rows (r, k, s, e, x) of a kind's matches that pass ``keep``: a match starts after the gaps and matches before it."""
    quoted = ("((?s:.*?))(" + pattern + ")").replace("'", "''")
    return f"""
SELECT r, {KINDS.index(kind)} AS k, s, s + len(x) AS e, x, t FROM (
  SELECT r, t, unnest(m) AS x, unnest(list_transform(range(1, len(m) + 1), lambda i:
      CAST(list_sum(list_transform(g[1:i], lambda y: len(y))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda y: len(y))), 0) AS BIGINT))) AS s
  FROM (SELECT r, t, regexp_extract_all(t, '{quoted}', 1) AS g, regexp_extract_all(t, '{quoted}', 2) AS m FROM docs))
WHERE {keep}"""


def _oracle() -> str:
    d = "regexp_replace(x, '[^0-9]', '', 'g')"
    digit = f"CAST({d}[len({d}) - i] AS INT)"
    luhn_sql = f"list_sum(list_transform(range(len({d})), lambda i: CASE WHEN i % 2 = 0 THEN {digit} ELSE 2 * {digit} - CASE WHEN {digit} > 4 THEN 9 ELSE 0 END END)) % 10 = 0"
    value = "(CASE WHEN c BETWEEN '0' AND '9' THEN CAST(c AS INT) ELSE ascii(c) - 55 END)"
    mod = lambda y: (f"(len({y}) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0, list_transform(string_split(substr({y}, 5) || substr({y}, 1, 4), ''), "     # noqa: E731
                     f"lambda c: {value})), lambda a, b: (a * CASE WHEN b < 10 THEN 10 ELSE 100 END + b) % 97) = 1)")
    weigh = "list_sum(list_transform(range(1, 10), lambda i: CAST(x[i] AS INT) * ([3, 7, 1])[(i - 1) % 3 + 1])) % 10 = 0 AND x <> '000000000'"
    iban = f"""
SELECT r, 4 AS k, s, s + len(y) AS e, y AS x, t FROM (
  SELECT *, list_filter(list_transform(range(0, 9), lambda i: array_to_string(string_split(x, ' ')[1:len(string_split(x, ' ')) - i], ' ')),
                        lambda y: {mod("replace(y, ' ', '')")})[1] AS y
  FROM ({_located("iban", IBAN.pattern, "true")})) WHERE y IS NOT NULL"""
    per_kind = lambda table, suffix: "CASE k " + " ".join(                                                    # noqa: E731
        rf"WHEN {i} THEN regexp_matches(around, '(?i)\b(?:{table[k]})\b')" for i, k in enumerate(KINDS)) + f" END AS {suffix}"
    start = "([" + ", ".join(str(START[k]) for k in KINDS) + "])[k + 1]"
    kinds = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
base AS ({_located("email", "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+", "true")}
UNION ALL {_located("ip", "[0-9]+(?:[.][0-9]+)(?:[.][0-9]+)(?:[.][0-9]+)",
                    "len(list_filter(string_split(x, '.'), lambda p: len(ltrim(p, '0')) > 3 OR coalesce(try_cast(ltrim(p, '0') AS INT), 0) > 255)) = 0")}
UNION ALL {_located("card", r"[0-9](?:[ -]?[0-9])+", f"len({d}) BETWEEN 13 AND 19 AND {luhn_sql}")}
UNION ALL {_located("phone", r"[+][0-9][ ().0-9-]+[0-9]", f"len({d}) BETWEEN 9 AND 15")}),
added AS ({iban}
UNION ALL {_located("ssn", SSN.pattern, "NOT regexp_matches(x, '^(000|666|9)|-00-|-0000$')")}
UNION ALL {_located("routing", ROUTING.pattern, weigh)}
UNION ALL {_located("local_phone", LOCAL_PHONE.pattern, "true")}),
found AS (
  SELECT * FROM base
  UNION ALL SELECT * FROM added a WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.r = a.r AND b.s < a.e AND a.s < b.e)),
scored AS (
  SELECT r, k, s, e, greatest(0, least(100, {start} + CASE WHEN good THEN {UP} ELSE 0 END - CASE WHEN bad THEN {DOWN} ELSE 0 END)) AS score
  FROM (SELECT *, {per_kind(FOR, "good")}, {per_kind(AGAINST, "bad")}
        FROM (SELECT *, substr(t, greatest(s - {NEAR}, 0) + 1, s - greatest(s - {NEAR}, 0)) || chr(10) || substr(t, e + 1, {NEAR}) AS around FROM found))),
digest AS (
  SELECT r, {", ".join(f"count(*) FILTER (k = {i}) AS n_{k}" for i, k in enumerate(BASE))},
         string_agg(concat(({kinds})[k + 1], ':', s, ':', e), ',' ORDER BY k, s) FILTER (k < {len(BASE)}) AS b,
         string_agg(concat(({kinds})[k + 1], ':', s, ':', e), ',' ORDER BY k, s) AS spans, string_agg(score, ',' ORDER BY k, s) AS scores
  FROM scored WHERE k < {len(BASE)} OR score >= {REPORT} GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)}, sha256(coalesce(b, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM docs LEFT JOIN digest USING (r)
"""


ORACLE = _oracle().replace(r"\x20", " ")
