"""Secret scans with multipart credential linking, in DataFrame and SQL functions only.

Strong findings (kinds ``assign``, ``access``, ``hex``) are reported wherever
they occur. Weak candidates are parts of a credential that mean little alone:
a user or client id, a mixed token, an endpoint. Parts have a role
(identifier, secret, endpoint) and an interval of code points. An interval
join within scopes (a text, cut into bins of ``SCOPE`` code points) brings
together parts that lie within ``SCOPE`` of each other; a weak candidate is
reported only if parts of other roles complete it: one strong part, or weak
parts of both other roles.

Positions come from splitting: a match starts after the gaps and matches
before it.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import materialise

SCOPE = 200
BROADCAST_ROWS = 200_000        # findings rows (a few hundred bytes each) that may be broadcast
PLACEHOLDER = "[SECRET]"


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


def _one_of(*words: str) -> str:
    return "(?:" + "|".join(map(_either_case, words)) + ")"


_IS = r"""["']?\x20*[:=]\x20*["']?"""
_PASS_WORDS = "(?:" + "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + \
    _either_case("api") + "_?" + _either_case("key") + ")"
ASSIGN = "(" + _PASS_WORDS[3:-1] + ")" + _IS + "([A-Za-z0-9+/_.=-]+)"
#: kind, role, strong, pattern, condition on a match ``x`` (``g``: its group 2, for assign)
KINDS = [
    ("assign", "secret", True, ASSIGN, "length(g) >= 6"),
    ("access", "identifier", True, "AKIA[A-Z0-9]{16,}", "true"),
    ("hex", "secret", True, "[0-9a-f]{24,}", "true"),
    ("weak_access", "identifier", False,
     _one_of("access_key_id", "accesskeyid", "client_id", "clientid", "username", "login") + _IS + "[A-Za-z0-9+/_.@=-]{3,}", "true"),
    ("weak_secret", "secret", False, "[A-Za-z0-9+/_-]{20,}", "x rlike '[0-9]' and x rlike '[a-z]' and x rlike '[A-Z]'"),
    ("endpoint", "endpoint", False, "[a-z][a-z0-9+.-]{1,15}://[^\\x00-\\x20\"'<>]+", "true"),
]
STRONG = [k[0] for k in KINDS if k[2]]
_ORDER = {k[0]: i for i, k in enumerate(KINDS)}
#: start, number of the kind, end (code points): sorts as reported; the same places in UTF-8 bytes
_SPAN = "struct<s:int,k:int,e:int,b:int,f:int>"


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def with_spans(df: DataFrame, text_col: str, prefix: str = "sp_") -> DataFrame:
    """``df`` and, for each kind, an array of its spans in the whole text (null text: none)."""
    keep = df.columns
    df = df.withColumn("__t", F.coalesce(F.col(text_col), F.lit("")))
    df = df.withColumns({f"__m_{k}": F.expr(f"regexp_extract_all(__t, {_sql(p)}, 0)") for k, _, _, p, _ in KINDS})
    # gaps only where something matched
    df = df.withColumns({f"__g_{k}": F.expr(f"case when size(__m_{k}) > 0 then "
                                        f"transform(split(__t, {_sql(p)}, -1), y -> named_struct('c', length(y), 'b', octet_length(y))) end")
                         for k, _, _, p, _ in KINDS})
    df = df.withColumn("__v_assign", F.expr(f"case when size(__m_assign) > 0 then regexp_extract_all(__t, {_sql(ASSIGN)}, 2) end"))
    spans = {}
    for k, _, _, _, condition in KINDS:
        group = "element_at(__v_assign, i)" if k == "assign" else "cast(null as string)"
        test = condition.replace("(g)", f"({group})").replace("x rlike", f"element_at(__m_{k}, i) rlike")
        spans[f"{prefix}{k}"] = F.expr(f"""
            case when size(__m_{k}) > 0 then aggregate(sequence(1, size(__m_{k})),
              named_struct('at', 0, 'by', 0, 'found', cast(array() as array<{_SPAN}>)),
              (a, i) -> named_struct(
                'at', a.at + element_at(__g_{k}, i).c + length(element_at(__m_{k}, i)),
                'by', a.by + element_at(__g_{k}, i).b + octet_length(element_at(__m_{k}, i)),
                'found', case when {test} then concat(a.found, array(named_struct(
                  's', a.at + element_at(__g_{k}, i).c, 'k', {_ORDER[k]},
                  'e', a.at + element_at(__g_{k}, i).c + length(element_at(__m_{k}, i)),
                  'b', a.by + element_at(__g_{k}, i).b,
                  'f', a.by + element_at(__g_{k}, i).b + octet_length(element_at(__m_{k}, i))))) else a.found end),
              a -> a.found) else cast(array() as array<{_SPAN}>) end""")
    return df.withColumns(spans).select(*keep, *spans)


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text_hash, strong, weak)`` of every row: sorted spans of the strong and the weak kinds.

    Weak spans that overlap a strong one are left out."""
    rows = with_spans(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")), "t")
    strong = F.array_sort(F.concat(*[F.col(f"sp_{k}") for k in STRONG]))
    weak = F.concat(*[F.col(f"sp_{k}") for k in _ORDER if k not in STRONG])
    rows = rows.select("id", text_hash(F.col("t")).alias("h"), strong.alias("strong"), weak.alias("weak"))
    return rows.withColumn("weak", F.expr("array_sort(filter(weak, w -> not exists(strong, b -> b.s < w.e and w.s < b.e)))"))


def link(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``(id, h, linked)``: the weak spans that parts within ``scope`` code points complete.

    ``found`` is ``scan``'s result. Equal rows (same id and text) meet as one;
    their findings are equal. Keys of the join are (row, bin), so neither a
    long text nor a frequent secret gathers in one task."""
    parts = found.filter(F.size("weak") > 0).select("id", "h", F.explode(F.concat("strong", "weak")).alias("p")).distinct()
    role = F.element_at(F.array(*[F.lit(r) for _, r, _, _, _ in KINDS]), F.col("p.k") + 1)
    parts = parts.select("id", "h", "p", role.alias("role"), (F.col("p.k") < len(STRONG)).alias("strong"))
    bins = lambda a, b: F.explode(F.sequence(F.floor(a / scope), F.floor(b / scope)))      # noqa: E731
    seekers = parts.filter(~F.col("strong")).select("id", "h", "p", "role", bins(F.col("p.s") - scope, F.col("p.e") + scope).alias("bin"))
    others = parts.select(F.col("id").alias("oid"), F.col("h").alias("oh"), F.col("p").alias("o"), F.col("role").alias("orole"),
                          F.col("strong").alias("ostrong"), bins(F.col("p.s"), F.col("p.e")).alias("obin"))
    near = (F.col("id").eqNullSafe(F.col("oid")) & (F.col("h") == F.col("oh")) & (F.col("bin") == F.col("obin"))
            & (F.col("role") != F.col("orole")) & (F.col("o.s") <= F.col("p.e") + scope) & (F.col("o.e") >= F.col("p.s") - scope))
    has = lambda r: F.max((F.col("orole") == r).cast("int"))                               # noqa: E731
    linked = (seekers.join(others, near).groupBy("id", "h", "p")
              .agg(F.max(F.col("ostrong").cast("int")).alias("strong"),
                   (has("identifier") + has("secret") + has("endpoint")).alias("roles"))
              .filter((F.col("strong") == 1) | (F.col("roles") >= 2)))
    return linked.groupBy("id", "h").agg(F.array_sort(F.collect_list("p")).alias("linked"))


def _joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in _ORDER])
    return F.array_join(F.transform(spans, lambda p: F.concat_ws(":", F.element_at(kinds, p["k"] + 1), p["s"].cast("string"),
                                                                  p["e"].cast("string"))), ",")


def with_linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``scan``'s rows and ``linked`` (empty where nothing is completed)."""
    linked = link(found, scope).select(F.col("id").alias("lid"), F.col("h").alias("lh"), "linked")
    joined = found.join(linked, F.col("id").eqNullSafe(F.col("lid")) & (F.col("h") == F.col("lh")), "left")
    return joined.select("id", "h", "strong", F.coalesce("linked", F.expr(f"cast(array() as array<{_SPAN}>)")).alias("linked"))


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row.

    A null or empty text has no spans: zero counts, the digest of no bytes and
    an empty string. Rows keep their number, also repeated ones and those
    without an id; other columns are ignored."""
    found = with_linked(materialise(scan(docs), "secret-spans"))
    count = lambda k: F.size(F.filter("strong", lambda p: p["k"] == _ORDER[k])).cast("long").alias(f"n_{k}")     # noqa: E731
    return found.select(F.col("id").alias("doc_id"), count("assign"), count("access"), count("hex"),
                        F.sha2(_joined(F.col("strong")), 256).alias("base_sha256"),
                        _joined(F.array_sort(F.concat("strong", "linked"))).alias("spans"))


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", placeholder: str = PLACEHOLDER) -> DataFrame:
    """``df`` with every reported span of ``text_col`` replaced by ``placeholder`` (overlapping spans by one).

    All rows and columns stay; a null text stays null."""
    found = with_linked(materialise(scan(df, id_col, text_col), "secret-spans"))
    found = (found.withColumn("__spans", F.array_sort(F.concat("strong", "linked"))).filter(F.size("__spans") > 0)
             .select(F.col("id").alias("__id"), F.col("h").alias("__h"), "__spans").dropDuplicates(["__id", "__h"]))
    # disjoint spans, then the pieces between them, cut from the bytes: each costs its own length only
    merged = F.expr("""
        aggregate(__spans, cast(array() as array<struct<b:int,f:int>>), (a, p) ->
          case when size(a) = 0 or p.b >= element_at(a, -1).f then concat(a, array(named_struct('b', p.b, 'f', p.f)))
               when p.f <= element_at(a, -1).f then a
               else concat(slice(a, 1, size(a) - 1), array(named_struct('b', element_at(a, -1).b, 'f', p.f))) end)""")
    pieces = F.expr(f"""
        case when __cut is null then `{text_col}` else
        array_join(zip_with(concat(array(0), transform(__cut, x -> x.f)), concat(transform(__cut, x -> x.b), array(length(__bytes))),
                            (a, b) -> cast(substring(__bytes, a + 1, b - a) as string)), '{placeholder}') end""")
    found = found.withColumn("__cut", merged).drop("__spans")
    found = materialise(found, "secret-findings")
    if found.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    joined = df.join(found, F.col(id_col).eqNullSafe(F.col("__id")) & (text_hash(F.col(text_col)) == F.col("__h")), "left")
    joined = joined.withColumn("__bytes", F.col(f"`{text_col}`").cast("binary"))
    return joined.withColumn(text_col, pieces).select(*[F.col(f"`{c}`") for c in df.columns])


def _duck(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _oracle() -> str:
    spans = []
    for k, role, strong, p, condition in KINDS:
        test = {"assign": "len(v) >= 6", "weak_secret": "regexp_matches(x, '[0-9]') AND regexp_matches(x, '[a-z]') AND regexp_matches(x, '[A-Z]')"}.get(k, "true")
        values = f"regexp_extract_all(t, {_duck(p)}, 2)" if k == "assign" else "m"
        spans.append(f"""
SELECT r, {_ORDER[k]} AS k, '{role}' AS role, {strong} AS strong, pos AS s, pos + len(x) AS e FROM (
  SELECT r, unnest(m) AS x, unnest(v) AS v, unnest(list_transform(range(len(m)), lambda i:
      CAST(list_sum(list_transform(g[1:i + 1], lambda y: len(y))) + coalesce(list_sum(list_transform(m[1:i], lambda y: len(y))), 0) AS BIGINT))) AS pos
  FROM (SELECT r, regexp_extract_all(t, {_duck(p)}) AS m, {values} AS v, string_split_regex(t, {_duck(p)}) AS g
        FROM (SELECT r, t, regexp_extract_all(t, {_duck(p)}) AS m FROM docs)))
WHERE {test}""")
    kinds = "[" + ", ".join(f"'{k}'" for k in _ORDER) + "]"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(spans)}),
strong AS (SELECT * FROM found WHERE strong),
weak AS (SELECT * FROM found w WHERE NOT strong
         AND NOT EXISTS (SELECT 1 FROM strong b WHERE b.r = w.r AND b.s < w.e AND w.s < b.e)),
parts AS (SELECT * FROM strong UNION ALL SELECT * FROM weak),
linked AS (
  SELECT w.r, w.k, w.s, w.e FROM weak w JOIN parts o
    ON o.r = w.r AND o.role <> w.role AND o.s <= w.e + {SCOPE} AND o.e >= w.s - {SCOPE}
  GROUP BY 1, 2, 3, 4 HAVING bool_or(o.strong) OR count(DISTINCT o.role) >= 2),
base AS (
  SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
         string_agg(concat(({kinds})[k + 1], ':', s, ':', e), ',' ORDER BY s, k, e) AS j FROM strong GROUP BY 1),
every AS (
  SELECT r, string_agg(concat(({kinds})[k + 1], ':', s, ':', e), ',' ORDER BY s, k, e) AS j
  FROM (SELECT r, k, s, e FROM strong UNION ALL SELECT r, k, s, e FROM linked) GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b.j, '')) AS base_sha256, coalesce(a.j, '') AS spans
FROM docs d LEFT JOIN base b ON b.r = d.r LEFT JOIN every a ON a.r = d.r
"""


ORACLE = _oracle()
