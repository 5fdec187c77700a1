"""``%`` time formats as Spark datetime patterns."""

from __future__ import annotations

import re

# Format codes and the Spark pattern letters for them.
# Parsing takes short numbers too, so numeric codes are single letters there.
PARSE_CODES = {
    "Y": "yyyy", "y": "yy", "m": "M", "d": "d", "e": "d", "H": "H", "I": "h", "M": "m", "S": "s",
    "b": "MMM", "h": "MMM", "B": "MMMM", "a": "E", "A": "EEEE", "p": "a", "j": "D", "z": "xx",
    "F": "yyyy-M-d", "T": "H:m:s", "R": "H:m", "D": "M/d/yy", "%": "'%'",
}
FORMAT_CODES = {
    "Y": "yyyy", "y": "yy", "m": "MM", "d": "dd", "H": "HH", "I": "hh", "M": "mm", "S": "ss.SSSSSS",
    "b": "MMM", "h": "MMM", "B": "MMMM", "a": "E", "A": "EEEE", "p": "a", "j": "DDD", "z": "xx",
    "Z": "zzz", "F": "yyyy-MM-dd", "T": "HH:mm:ss.SSSSSS", "R": "HH:mm", "D": "MM/dd/yy", "%": "'%'",
}


def to_spark_pattern(fmt: str, codes: dict[str, str] = PARSE_CODES) -> str:
    """Spark pattern for a ``%`` format; codes without a counterpart raise.

    Adjacent numeric codes need fixed widths, as nothing separates them.
    """
    pieces = re.findall(r"%.|[^%]+|%", fmt, re.S)
    out = []
    for i, piece in enumerate(pieces):
        if not piece.startswith("%"):
            out.append(re.sub(r"[A-Za-z']+", lambda m: "'" + m[0].replace("'", "''") + "'", piece))
            continue
        code = piece[1:]
        if code not in codes:
            raise ValueError(f"Time format code '{piece}' is not supported")
        letters = codes[code]
        beside = (i > 0 and pieces[i - 1].startswith("%")) or (
            i + 1 < len(pieces) and pieces[i + 1].startswith("%")
        )
        out.append(letters * 2 if beside and letters in ("M", "d", "H", "h", "m", "s") else letters)
    return "".join(out)
