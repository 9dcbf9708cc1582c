"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import licences

#: The published jump hash over 17 steps: 128-bit arithmetic keeps the 64-bit generator exact.
_JUMP = """
WITH RECURSIVE walk AS (
  SELECT doc_id, n, (CASE WHEN doc_id < 0 THEN 18446744073709551616::HUGEINT + doc_id ELSE doc_id::HUGEINT END) AS key, -1::BIGINT AS b, 0::BIGINT AS j
  FROM (SELECT DISTINCT doc_id FROM documents), (VALUES (16), (17)) AS s(n)
  UNION ALL
  SELECT doc_id, n, next, j, CAST(floor((j + 1)::DOUBLE * (2147483648.0::DOUBLE / (next // 8589934592 + 1)::DOUBLE)) AS BIGINT)
  FROM (SELECT *, (((key // 4294967296) * 2862933555777941757 % 4294967296) * 4294967296 + (key % 4294967296) * 2862933555777941757 + 1) % 18446744073709551616 AS next FROM walk WHERE j < n)
)"""
SHARDS = f"{_JUMP} SELECT doc_id, max(b) FILTER (WHERE n = 16) AS shard, max(b) FILTER (WHERE n = 17) AS grown_shard FROM walk WHERE j >= n GROUP BY doc_id"


def _crc_table() -> list[int]:
    """The 256 remainders of the CRC-32 polynomial, from its rule."""
    out = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        out.append(byte)
    return out


#: CRC-32 of a text's bytes, byte by byte.
_CRC = f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(h) // 2 + 1), lambda i: ('0x' || substr(h, 2 * i - 1, 2))::BIGINT)),
  lambda c, b: xor({_crc_table()}[(xor(c, b) & 255) + 1]::BIGINT, c >> 8)), 4294967295::BIGINT)"""
SHARDING = f"""
WITH shards AS ({SHARDS.strip().replace("WITH RECURSIVE", "WITH RECURSIVE", 1)}),
sized AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
summed AS (SELECT doc_id, length(h) // 2 + 1 AS size, {_CRC} AS text_crc32 FROM sized),
rows AS (SELECT *, (((CASE WHEN doc_id < 0 THEN 18446744073709551616::HUGEINT + doc_id ELSE doc_id::HUGEINT END) * 2862933555777941757 + 1) % 4294967296 // 256 + text_crc32) % 1024 AS g FROM summed)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
  CAST(row_number() OVER (PARTITION BY shard ORDER BY g, doc_id, size, text_crc32) - 1 AS BIGINT) AS slot, CAST(grown_shard AS INTEGER) AS grown_shard
FROM rows JOIN shards USING (doc_id)"""

#: Windows of at most 512 tokens and 128 of history, turn by turn; prefix sums give each turn's history.
_ESCAPED = "length(replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), ']', '&#93;'))"
CHATS = rf"""
WITH RECURSIVE said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) AS v(conv_id, turn, role, text)),
turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS i, len(regexp_extract_all(text, '[A-Za-z0-9]+|[^A-Za-z0-9\s]')) + 4 AS tok,
  11 + {_ESCAPED.format('role')} + {_ESCAPED.format('text')} AS c FROM said),
sums AS (SELECT *, sum(tok) OVER w - tok AS before, sum(c) OVER w - c AS c_before, first_value(role) OVER w = 'system' AS led, first_value(tok) OVER w AS lead_tok, first_value(c) OVER w AS lead_c
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
past AS (SELECT a.conv_id, a.i, max(a.before - b.before) AS held, max(a.c_before - b.c_before) AS held_c FROM sums a JOIN sums b ON a.conv_id = b.conv_id AND b.i <= a.i
  AND b.i >= (CASE WHEN a.led THEN 1 ELSE 0 END) AND a.before - b.before <= 128 GROUP BY 1, 2),
steps AS (SELECT s.*, CASE WHEN led THEN lead_tok ELSE 0 END AS system, CASE WHEN led THEN lead_c ELSE 0 END AS system_c, coalesce(held, 0) AS held, coalesce(held_c, 0) AS held_c FROM sums s LEFT JOIN past USING (conv_id, i)),
walk AS (SELECT conv_id, i, CAST(tok AS BIGINT) AS used, CAST(0 AS BIGINT) AS extra FROM steps WHERE i = 0
  UNION ALL SELECT s.conv_id, s.i, CAST(CASE WHEN w.used + s.tok <= 512 THEN w.used + s.tok WHEN s.held + s.system + s.tok <= 512 THEN s.held + s.system + s.tok ELSE s.system + s.tok END AS BIGINT),
    CAST(CASE WHEN w.used + s.tok <= 512 THEN 0 WHEN s.held + s.system + s.tok <= 512 THEN s.held_c + s.system_c ELSE s.system_c END AS BIGINT)
  FROM walk w JOIN steps s ON s.conv_id = w.conv_id AND s.i = w.i + 1),
extra AS (SELECT conv_id, sum(extra) AS extra FROM walk GROUP BY 1)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(c) + any_value(extra) AS BIGINT) AS formatted_chars
FROM turns JOIN extra USING (conv_id) GROUP BY conv_id"""

SQL: dict[str, str] = {
    "op5_licences": licences.oracle_sql(),
    "op8_chat_formatting": CHATS,
    "op9_sharding": SHARDING,
}
