"""DuckDB SQL of the columns of operators that SQL can express, and the queries that take those columns from the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words, in SQL's regular expressions.
_WORD = r"[^\x20\x09-\x0D]+"


def _crc32_of(codes: str) -> str:
    """CRC-32 of a list of bytes, by its definition over bits."""
    step = "lambda c, z: xor(c >> 1, (c & 1) * 3988292384)"
    byte = f"lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda z: 0::ubigint)), {step})"
    return f"xor(list_reduce(list_prepend(4294967295::ubigint, {codes}), {byte}), 4294967295::ubigint)"


def _crc32(text: str) -> str:
    """CRC-32 of a text of ASCII characters."""
    return _crc32_of(f"list_transform(string_split({text}, ''), lambda x: ascii(x)::ubigint)")


def _spans(kind: str, rank: int, pattern: str, good: str) -> str:
    """Rows (row, doc_id, kind, rank, s, e, m) of a kind's good matches; places follow from the lengths of what lies between matches."""
    return rf"""
      select row, doc_id, '{kind}' as kind, {rank} as rank, u.s as s, u.s + length(u.m) as e, u.m as m
      from (
        select row, doc_id, unnest(list_transform(range(1, len(ms) + 1), lambda i: {{'m': ms[i],
          's': coalesce(list_sum(list_transform(parts[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0)}})) as u
        from (select row, doc_id, regexp_extract_all(text, '{pattern}') as ms, regexp_split_to_array(text, '{pattern}') as parts from docs)
      )
      where {good.replace("{m}", "u.m")}"""


def _found(kinds: list[tuple[str, str, str]]) -> str:
    """A row a document: the kinds' numbers of good matches, and the digest of all of them."""
    rows = " union all ".join(_spans(kind, k, pattern.replace("'", "''"), good) for k, (kind, pattern, good) in enumerate(kinds))
    counts = ", ".join(f"count(*) filter (kind = '{kind}') as n_{kind}" for kind, _, _ in kinds)
    zeros = ", ".join(f"coalesce(n_{kind}, 0) as n_{kind}" for kind, _, _ in kinds)
    return rf"""
    with docs as (select row_number() over () as row, doc_id, coalesce(text, '') as text from documents),
    spans as ({rows}),
    digests as (
      select row, {counts}, string_agg(kind || ':' || s::bigint || ':' || e::bigint, ',' order by s, rank) as line from spans group by row
    )
    select doc_id, {zeros}, sha256(coalesce(line, '')) as base_sha256 from docs left join digests using (row)"""


_DIGITS = "regexp_replace({m}, '[^0-9]', '', 'g')"
_LUHN = f"list_sum(list_transform(string_split(reverse({_DIGITS}), ''), lambda c, i: case when i % 2 = 1 then c::int when c::int > 4 then 2 * c::int - 9 else 2 * c::int end)) % 10 = 0"

SECRETS = [
    ("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
     r"length(regexp_extract({m}, '^[A-Za-z_]+[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)$', 1)) >= 12"),
    ("access", "AKIA[A-Z0-9]+", "length({m}) >= 18"),
    ("hex", "[0-9a-f]+", "length({m}) >= 16"),
]
PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "list_aggregate(list_transform(string_split({m}, '.'), lambda p: coalesce(try_cast(p as hugeint), 999) <= 255), 'bool_and')"),
    ("card", r"[0-9]([\x20-]?[0-9])+", f"length({_DIGITS}) between 12 and 19 and {_LUHN}"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) between 9 and 15"),
]

QUALITY = rf"""
    with docs as (select row_number() over () as row, doc_id, coalesce(text, '') as text from documents),
    parts as (
      select row, doc_id, regexp_extract_all(text, '{_WORD}') as words, len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) as lines
      from docs
    ),
    windows as (
      select row, i, count(*) over (partition by row, words[i], words[i + 1], words[i + 2]) as n
      from (select row, words, unnest(range(1, len(words) - 1)) as i from parts)
    ),
    covered as (select row, count(distinct i + k) as n_repeat_words from windows, (values (0), (1), (2)) t(k) where n > 1 group by row),
    counts as (
      select doc_id, len(words) as n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::bigint as word_chars, n_symbols,
        len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words
      from parts left join covered using (row)
    )
    select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counts"""

LANGUAGE_MODEL = rf"""
    with docs as (
      select row_number() over () as row, doc_id, ({_crc32("coalesce(doc_id::varchar, '')")} % 5 = 1 and doc_id is not null) as held_out,
        list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}'), ' ') as tokens
      from documents
    ),
    counts as (select token, count(*) as c from (select unnest(tokens) as token from docs where not held_out) group by token),
    sums as (select coalesce(sum(c), 0)::bigint as total, count(*) as words from counts),
    each as (select row, unnest(tokens) as token from docs)
    select doc_id, held_out, count(*) as n_tokens, count(c) as n_known, total as train_tokens,
      round(sum(log10((coalesce(c, 0) + 0.5) / (total + 0.5 * (words + 1)))), 3) as base_score
    from each join docs using (row) left join counts using (token), sums group by row, doc_id, held_out, total"""

FILL_MIDDLE = r"""
    with docs as (
      select doc_id, t, length(t) as n, list_transform(range(4), lambda k: ('0x' || substr(sha256('1:' || coalesce(doc_id::varchar, '')), 8 * k + 1, 8))::bigint) as h
      from (select doc_id, coalesce(text, '') as t from documents)
    ),
    cuts as (
      select *, least(h[1] % (n + 1), h[2] % (n + 1)) as a, greatest(h[1] % (n + 1), h[2] % (n + 1)) as b,
        case when n = 0 or regexp_matches(t, '<[PSM]>') or h[3] % 100 >= 90 then 'plain' when h[4] % 100 < 20 then 'spm' else 'psm' end as form
      from docs
    ),
    parts as (select *, substr(t, 1, a) as prefix, substr(t, a + 1, b - a) as middle, substr(t, b + 1) as suffix from cuts)
    select doc_id, n, form, if(form = 'plain', null, a)::bigint as prefix_chars, if(form = 'plain', null, b - a)::bigint as middle_chars,
      sha256(case form when 'plain' then t when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
      sha256(t) as restored_sha256
    from parts"""

#: Letters up to U+00FF as their UTF-8 bytes.
_UTF8 = "flatten(list_transform(string_split({}, ''), lambda c: if(ascii(c) < 128, [ascii(c)::ubigint], [(192 + ascii(c) // 64)::ubigint, (128 + ascii(c) % 64)::ubigint])))"
SPELLING = rf"""
    with recursive docs as (
      select row_number() over () as row, coalesce(doc_id::varchar, '') as doc_id,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
      from documents
    ),
    runs as (select row, doc_id, run, count(*) as c from (select row, doc_id, unnest(regexp_extract_all(t, '[a-z\x{{C0}}-\x{{FF}}]+')) as run from docs) where length(run) > 6 group by all),
    hashed as (select run, c, {_crc32_of(_UTF8.format("doc_id || ':' || run"))} as h from runs),
    dropped as (select if(h % 31 = 0, substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2), run) as word, c from hashed),
    words as (select word, sum(c)::bigint as n from dropped where length(word) > 6 group by word having sum(c) > 1),
    less as (select word, n, i, substr(word, 1, i::int - 1) || substr(word, i::int + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
    ends as (
      select a.word, b.word as other, b.n as n_other from less a join less b on a.rest = b.rest and a.i = b.i and a.word <> b.word
      union select a.word, b.word, b.n from less a join words b on a.rest = b.word
      union select b.word, a.word, a.n from less a join words b on a.rest = b.word
    ),
    near as (select word, count(*) as n_near, first(other order by n_other desc, encode(other)) as other, max(n_other) as n_other from ends group by word),
    formed as (
      select word, n, coalesce(n_near, 0) as n_near, if(n_other >= 10 * n, other, null) as form, if(n_other >= 10 * n, n_other, null) as form_n
      from words left join near using (word)
    ),
    walk as (
      select word, word as root from formed
      union all select walk.word, form from walk join formed on walk.root = formed.word where form is not null
    ),
    roots as (select walk.word, walk.root from walk join formed on walk.root = formed.word where form is null)
    select word, n, form, root, n_near, form_n from formed join roots using (word)"""

#: For each query: the operator's query, the columns that it takes from that, and their SQL.
_BASES: dict[str, tuple[str, list[str | Column], str]] = {
    "secrets_base": ("op6_secrets", ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"], _found(SECRETS)),
    "pii_base": ("op10_pii", ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"], _found(PII)),
    "quality_base": ("op9_quality", ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"], QUALITY),
    "language_model_base": ("op5_language_model", ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"], LANGUAGE_MODEL),
}


def bases(operators: dict[str, Callable[[SparkSession, str], DataFrame]]) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries of _BASES, which call the operators' own queries."""

    def query(operator: str, columns: list[str | Column]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = operators[operator](spark, sf_dir).select(*columns)
            return out.withColumn("base_score", F.round("base_score", 3)) if "base_score" in out.columns else out

        return run

    return {name: query(operator, columns) for name, (operator, columns, _) in _BASES.items()}


ORACLES = {name: sql for name, (_, _, sql) in _BASES.items()} | {"op11_fill_middle": FILL_MIDDLE, "op13_spelling": SPELLING}
