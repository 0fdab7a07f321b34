"""Pieces of DuckDB SQL that several checks share."""

#: The table ``t`` of CRC-32 remainders of the 256 bytes, by its rule.
CRC_TABLE = """SELECT list_transform(range(256), lambda i: list_reduce(
    list_prepend(i, range(8)), lambda c, j: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END
)) AS t"""
#: CRC-32 of a list of bytes, where that table is in scope.
CRC = "xor(list_reduce(list_prepend(4294967295, {}), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"
#: UTF-8 bytes of a text of code points below 2,048.
BYTES = """flatten(list_transform(string_split({}, ''), lambda x: CASE
    WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)] END))"""


def crc32(text: str) -> str:
    """CRC-32 of a text expression."""
    return CRC.format(BYTES.format(text))
