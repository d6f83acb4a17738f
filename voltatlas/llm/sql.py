"""SQL of the checksum that several operators use, for DuckDB."""

from __future__ import annotations

# The table of CRC-32 by byte, as a one-row relation ``crc_table(t)``.
CRC_TABLE = """
crc_table as materialized (
  select list(list_reduce(list_concat([i::ubigint], list_transform(range(8), lambda k: 0::ubigint)),
                          lambda c, z: case when c % 2 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end) order by i) as t
  from range(256) r(i))"""


def crc32(text: str, table: str = "t") -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a text."""
    code = f"hex(encode({text}))"
    byte = f"('0x' || substr({code}, (2 * k + 1)::bigint, 2))::ubigint"
    steps = f"list_prepend(4294967295::ubigint, list_transform(range(length({code}) // 2), lambda k: {byte}))"
    return f"xor(4294967295::ubigint, list_reduce({steps}, lambda s, b: xor({table}[(xor(s, b) & 255)::bigint + 1], s >> 8)))::bigint"


LOWER_ASCII = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
