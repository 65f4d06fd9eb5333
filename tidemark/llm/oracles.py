"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from tidemark.llm.mixing import KEEP, MOST_COPIES, ROUNDS, TEMPER


def mixing_sql() -> str:
    """Words, topics, raked cells (each scaling a table of its own) and the dice."""
    steps = [
        r"""counted AS (SELECT doc_id, source, lang, coalesce(text, '') AS t,
      len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n FROM documents)""",
        """typed AS (SELECT doc_id, source, lang, n + 1 AS tokens, CASE WHEN n = 0 THEN 'empty'
      WHEN 10 * (length(t) - length(replace(t, '|', ''))) >= n THEN 'table'
      WHEN 8 * (length(t) - length(replace(t, chr(10), ''))) >= n THEN 'lines'
      WHEN n < 100 THEN 'note' WHEN n < 1000 THEN 'article' ELSE 'book' END AS topic FROM counted)""",
        "cells AS (SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS tokens FROM typed GROUP BY ALL)",
    ]
    for margin, power in TEMPER.items():
        steps.append(f"raised_{margin} AS (SELECT {margin}, pow(sum(tokens), {power}) AS raised FROM cells GROUP BY 1)")
        steps.append(
            f"target_{margin} AS (SELECT {margin}, raised / (SELECT sum(raised) FROM raised_{margin}) AS target FROM raised_{margin})"
        )
    now = "f0"
    steps.append("f0 AS MATERIALIZED (SELECT *, tokens AS fitted FROM cells)")
    for i in range(ROUNDS):
        for margin in TEMPER:
            then = f"f{i}_{margin}"
            steps.append(
                f"{then} AS MATERIALIZED (SELECT f.* REPLACE (fitted * target / sum(fitted) OVER (PARTITION BY f.{margin}) AS fitted)"
                f" FROM {now} f JOIN target_{margin} t ON f.{margin} IS NOT DISTINCT FROM t.{margin})"
            )
            now = then
    wanted = f"fitted * {float(KEEP)} * (SELECT CAST(sum(tokens) AS DOUBLE) FROM {now}) / tokens"
    steps.append(f"odds AS (SELECT *, least({wanted}, {float(MOST_COPIES)}) AS weight FROM {now})")
    dice = "CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13)) AS BIGINT) / 4503599627370496.0"
    return "WITH " + ",\n".join(steps) + f"""
SELECT *, copies > 0 AS kept FROM (SELECT d.doc_id, d.source, d.lang, d.topic, CAST(d.tokens AS BIGINT) AS n_tokens, least(weight, 1.0) AS probability,
  weight, CAST(floor(weight) + CASE WHEN {dice} < weight - floor(weight) THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM typed d JOIN odds o ON d.source IS NOT DISTINCT FROM o.source AND d.lang IS NOT DISTINCT FROM o.lang
  AND d.topic IS NOT DISTINCT FROM o.topic) x"""


def crc32_sql(number: str) -> str:
    """The unsigned CRC-32 of a decimal number (null: of the empty text), bit by bit."""
    digits = f"[ascii(c)::BIGINT FOR c IN regexp_extract_all(coalesce({number}::VARCHAR, ''), '.')]"
    byte = "list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), lambda crc, byte: {byte}), 4294967295)"


def manifest_sql() -> str:
    """Leaves, the trees level by level, and each leaf's path folded level by level."""

    def leaf(n_chars: str) -> str:
        fields = ("doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text")
        return "sha256(" + " || ".join(f"coalesce(strlen({x})::VARCHAR || ':' || {x}, '-')" for x in fields) + ")"

    def tree(name: str, of: str, leaves: str) -> str:
        return f"""{name}({of}, level, place, width, digest) AS ({leaves} UNION ALL
  SELECT {of}, level + 1, place // 2, (width + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
  FROM {name} WHERE width > 1 GROUP BY {of}, level, place // 2, width)"""

    def folded(name: str, nodes: str, of: str, start: str) -> str:
        sibling = f"s.{of} IS NOT DISTINCT FROM f.{of} AND s.level = f.level AND s.place = xor(f.place, 1)"
        here = f"n.{of} IS NOT DISTINCT FROM f.{of} AND n.level = f.level AND n.place = f.place AND n.width > 1"
        return f"""{name}(row_no, lang, top, level, place, acc, proof) AS ({start} UNION ALL
  SELECT f.row_no, f.lang, f.top, f.level + 1, f.place // 2, CASE WHEN s.digest IS NULL THEN sha256(f.acc)
    WHEN f.place % 2 = 1 THEN sha256(s.digest || f.acc) ELSE sha256(f.acc || s.digest) END, f.proof || coalesce(s.digest, '')
  FROM {name} f JOIN {nodes} n ON {here} LEFT JOIN {nodes} s ON {sibling})"""

    places = "row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place"
    return f"""WITH RECURSIVE leaves AS (SELECT *, {places}, count(*) OVER (PARTITION BY lang) AS width, row_number() OVER () AS row_no
  FROM (SELECT doc_id, lang, {leaf("n_chars")} AS leaf, {leaf("n_chars + 1")} AS other, {crc32_sql("doc_id")} % 7 = 0 AS tampered
    FROM documents)),
{tree("nodes", "lang", "SELECT lang, 0, place, width, leaf FROM leaves")},
subroots AS (SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM nodes WHERE width = 1),
{tree("tops", "top", "SELECT 0, 0, place, (SELECT count(*) FROM subroots), subroot FROM subroots")},
{folded("below", "nodes", "lang", "SELECT row_no, lang, 0, 0, place, CASE WHEN tampered THEN other ELSE leaf END, '' FROM leaves")},
{folded("above", "tops", "top", """SELECT row_no, s.lang, 0, 0, s.place, acc, proof FROM
  (SELECT * FROM below QUALIFY level = max(level) OVER (PARTITION BY row_no)) b JOIN subroots s ON s.lang IS NOT DISTINCT FROM b.lang""")}
SELECT l.doc_id, l.leaf, s.subroot, r.digest AS root, sha256(a.proof) AS proof_sha256, a.acc AS folded_root, a.acc = r.digest AS verified
FROM (SELECT * FROM above QUALIFY level = max(level) OVER (PARTITION BY row_no)) a JOIN leaves l ON l.row_no = a.row_no
JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang JOIN tops r ON r.width = 1"""
