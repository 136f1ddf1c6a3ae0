"""Column expressions for text cleaning.  All built-in, codegen-friendly."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.spec import MESSAGE_KEYS, MESSAGE_TOKENS, NULL_TOKENS

# Java regexes need (?U) so that \s also matches Unicode spaces such as NBSP,
# like Python's str.strip() and re's \s do.
_BLANK = r"(?U)^\s*$"
_EDGE_SPACE = r"(?U)^\s+|\s+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Unicode-aware trim of both ends (Python ``str.strip``).  The regex runs only
    when the first or last character is not a visible ASCII character."""
    c = _col(c)
    plain = F.substring(c, 1, 1).between("!", "~") & F.substring(c, -1, 1).between("!", "~")
    return F.when(plain, c).otherwise(F.regexp_replace(c, _EDGE_SPACE, ""))


def blank_to_null(c) -> Column:
    """Empty or whitespace-only text -> NULL; other values unchanged."""
    c = _col(c)
    return F.when(c.rlike(_BLANK), F.lit(None)).otherwise(c)


def is_null_token(c) -> Column:
    s = F.lower(strip(c))
    return s.isin(*NULL_TOKENS) | (s == "")


def clean_text(c) -> Column:
    """Trimmed text; blank and the null tokens (nan, none, <na>) -> NULL."""
    s = strip(c)
    return F.when(F.lower(s).isin(*NULL_TOKENS) | (s == ""), F.lit(None)).otherwise(s)


def flag_normalize(c) -> Column:
    """Change flag: trimmed upper case."""
    return F.upper(strip(c))


def message_text(rec) -> Column:
    """Status text of a parsed record (map<string,string>): first of the message keys present."""
    rec = _col(rec)
    return F.lower(strip(F.coalesce(*[rec.getItem(k) for k in MESSAGE_KEYS], F.lit(""))))


def is_status_message(rec) -> Column:
    """True when a parsed record is a 'no data' / error envelope rather than data."""
    txt = message_text(rec)
    cond = F.lit(False)
    for tok in MESSAGE_TOKENS:
        cond = cond | F.instr(txt, tok).__gt__(0)
    return cond


def cut(c, n: int) -> Column:
    """First ``n`` characters (error texts in logs and reports)."""
    return F.substring(_col(c), 1, n)
