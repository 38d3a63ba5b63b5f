"""DuckDB SQL of the queries that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op8_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), k AS (
  SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) AS keep_id
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k
"""

ORACLE["op10_warc"] = """
SELECT page_id, coalesce(strlen(html), 0) AS n_bytes, sha256(coalesce(html, '')) AS payload_sha256,
       CASE WHEN ((page_id % 97) + 97) % 97 = 13 AND contains(html, '<') THEN 'damaged' ELSE 'intact' END AS status
FROM pages
"""

ORACLE["op11_hard_negatives"] = """
WITH r AS (
  SELECT DISTINCT vec_id, CASE WHEN ((vec_id % 7) + 7) % 7 = 0 THEN (((label + 1) % 10) + 10) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS z
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, list_dot_product(a.z, b.z)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
       s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND s.label <> p.own
  AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) <= 3
"""


def _manifest(below: int = 6, above: int = 4) -> str:
    """Trees of ``below`` levels in a source and ``above`` over the sources: a
    table of nodes and a table of siblings for each level."""
    crc = ("list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
           "lambda c: ascii(c)::BIGINT)), lambda r, b: list_reduce(list_concat([xor(r, b)], [1, 1, 1, 1, 1, 1, 1, 1]::BIGINT[]), "
           "lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))")

    def part(c: str) -> str:
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"

    fields = " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ctes = [f"""leaf AS (
      SELECT doc_id, source, sha256({fields} || {part('text')}) AS digest,
             CASE WHEN xor({crc}, 4294967295) % 5 = 0 THEN sha256({fields} || {part(lowered)})
                  ELSE sha256({fields} || {part('text')}) END AS tampered FROM documents)""",
            """tree AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) AS s,
      row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS i FROM leaf)"""]

    def levels(name: str, start: str, many: int) -> None:
        ctes.append(f"{name}0 AS ({start})")
        for k in range(many):
            ctes.append(f"""{name}s{k} AS (SELECT *, count(*) OVER (PARTITION BY s) > 1 AS live,
              coalesce(string_agg(digest, '') OVER (PARTITION BY s, i // 16 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
              coalesce(string_agg(digest, '') OVER (PARTITION BY s, i // 16 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
              FROM {name}{k})""")
            ctes.append(f"""{name}{k + 1} AS (SELECT s, i // 16 AS i,
              CASE WHEN any_value(live) THEN sha256(string_agg(digest, '' ORDER BY i)) ELSE any_value(digest) END AS digest
              FROM {name}s{k} GROUP BY s, i // 16)""")

    levels("a", "SELECT s, i, digest FROM tree", below)
    levels("b", f"SELECT 0 AS s, s - 1 AS i, digest FROM a{below}", above)
    prev = "SELECT doc_id, s, i, s - 1 AS si, digest AS leaf, tampered AS f, '' AS proof FROM tree"
    for name, place, own, many in (("a", "p.i", "p.s", below), ("b", "p.si", "0", above)):
        for k in range(many):
            step = f"path{name}{k}"
            ctes.append(f"""{step} AS (SELECT p.doc_id, p.s, p.i, p.si, p.leaf,
              CASE WHEN n.live THEN sha256(n.l || p.f || n.r) ELSE p.f END AS f,
              CASE WHEN n.live THEN p.proof || n.l || n.r ELSE p.proof END AS proof
              FROM ({prev}) p JOIN {name}s{k} n ON n.s = {own} AND n.i = {place} // {16 ** k})""")
            prev = f"SELECT * FROM {step}"
    return "WITH " + ", ".join(ctes) + f"""
    SELECT p.doc_id, p.leaf, a.digest AS subroot, b.digest AS root, sha256(p.proof) AS proof_sha256, p.f AS folded_root,
           p.f = b.digest AS verified FROM ({prev}) p JOIN a{below} a ON a.s = p.s CROSS JOIN b{above} b"""


ORACLE["op12_manifest"] = _manifest()

ORACLE["op13_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), h AS (
  SELECT key, max(doc_id) AS keep_id FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), m AS (
  SELECT k.doc_id, k.i, k.line, h.key IS NOT NULL AND k.doc_id <> h.keep_id AS gone FROM k LEFT JOIN h ON k.key = h.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
