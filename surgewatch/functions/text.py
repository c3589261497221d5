"""Text and token-array expressions.

Two tokenizer forms exist:

* ``preprocess_text`` + ``tokenize`` follow the reference job step by step
  (three regex replacements, trim, lower-case, split on non-word characters,
  minimum length 2).
* ``words`` gives the same token array in one regex pass.  After the
  preprocessing only ASCII letters, digits and spaces remain, so the tokens
  are exactly the maximal ``[A-Za-z0-9]`` runs of the raw text that are at
  least two characters long, lower-cased.  Lower-casing happens after the
  extraction because some non-ASCII letters lower-case to ASCII ones (the
  Kelvin sign becomes ``k``); the reference removes them first.

Both are built-in expressions: no Python runs per row.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from surgewatch.functions.stopwords import ENGLISH_STOPWORDS

# Line breaks recognised by Python's str.splitlines (the
# Threads text cleaner splits on them).
LINE_BREAK_RE = r"\r\n|[\n\r\x0B\f\x1C\x1D\x1E\x85\u2028\u2029]"
# Whitespace per Python's str.isspace, written out so that Java
# and RE2 read the class the same way.
PY_SPACE_CLASS = (r"[\t\n\x0B\f\r\x1C-\x1F \x85\xA0\x{1680}\x{2000}-\x{200A}"
                  r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")

# The characters of that class.
PY_SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                              0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

# Relative-time lines dropped from Threads text
# (Korean minutes/hours/days, Vietnamese minutes/hours/days).
RELATIVE_TIME_RE = (
    rf"^{PY_SPACE_CLASS}*(\p{{Nd}}+{PY_SPACE_CLASS}*(분|시간|일)|\p{{Nd}}+{PY_SPACE_CLASS}*phút"
    rf"|\p{{Nd}}+{PY_SPACE_CLASS}*giờ|\p{{Nd}}+{PY_SPACE_CLASS}*ngày){PY_SPACE_CLASS}*$"
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def preprocess_text(text) -> Column:
    """Keep ASCII letters and digits, every run of anything else as one space; trim."""
    return F.trim(F.regexp_replace(_col(text), "[^A-Za-z0-9]+", " "))


def tokenize(clean_text, min_length: int = 2) -> Column:
    """Lower-case, split on non-word characters, keep tokens of ``min_length``+."""
    parts = F.split(F.lower(_col(clean_text)), r"\W")
    return F.filter(parts, lambda x: F.length(x) >= min_length)


def words(text, min_length: int = 2) -> Column:
    """Same array as ``tokenize(preprocess_text(text))`` in one regex pass.

    Null text gives an empty array (the reference tokenizer fails on null).
    """
    runs = F.regexp_extract_all(_col(text), F.lit(f"[A-Za-z0-9]{{{min_length},}}"), 0)
    return F.coalesce(F.transform(runs, lambda x: F.lower(x)),
                      F.array().cast("array<string>"))


def words_like(text, keywords: list[str]) -> Column:
    """Those of ``words`` that begin with the first two characters of one of ``keywords`` (lower-case ASCII
    letters and digits, two at least) and are not shorter or longer than all of them; others may come, too.

    Most tokens are passed over inside the regex: no string is made of them.
    """
    either = lambda cs: "".join(sorted({d for c in cs for d in (c, c.upper())}))
    first, second = (either(w[i] for w in keywords) for i in (0, 1))
    shortest, longest = min(map(len, keywords)), max(map(len, keywords))
    rest = f"[A-Za-z0-9]{{{shortest - 2},{longest - 2}}}(?![A-Za-z0-9])"
    # the characters are looked at before what stands ahead of them: few pass
    runs = F.regexp_extract_all(_col(text), F.lit(f"[{first}][{second}](?<![A-Za-z0-9]..){rest}"), 0)
    return F.coalesce(F.transform(runs, lambda x: F.lower(x)), F.array().cast("array<string>"))


def remove_stopwords(tokens, stopwords: Iterable[str] = ENGLISH_STOPWORDS) -> Column:
    """Drop stopwords (case-insensitive, repeats kept), as StopWordsRemover."""
    sw = sorted({w.lower() for w in stopwords})  # a literal set: one hash probe per token
    return F.filter(_col(tokens), lambda x: ~F.lower(x).isin(sw))


def lower_tokens(tokens) -> Column:
    return F.transform(_col(tokens), lambda x: F.lower(x))


def flatten_text(text) -> Column:
    """Newlines to spaces and whitespace trimmed at both ends; null to ''."""
    c = F.translate(F.coalesce(_col(text), F.lit("")), "\n", " ")
    return F.regexp_replace(c, rf"^{PY_SPACE_CLASS}+|{PY_SPACE_CLASS}+$", "")


def clean_post_text(text, username) -> Column:
    """Threads text cleaner.

    Per line: strip, drop blank lines, cut leading whitespace-separated
    tokens equal to the username (rejoined with single spaces only when a
    token was cut), drop lines that are only a relative time; rejoin with
    ``\\n``.  Null and empty text pass through unchanged.
    """
    t, u = _col(text), _col(username)
    # a trim looks at a line's ends only, a regex at each of its characters
    lines = F.transform(F.split(t, LINE_BREAK_RE), lambda ln: F.btrim(ln, F.lit(PY_SPACES)))
    lines = F.filter(lines, lambda ln: ln != "")

    # leading copies of the username: one regex per post (``\\Q..\\E``-quoted
    # username, as Pattern.quote does), compiled once and reused for its lines
    quoted = F.concat(F.lit("\\Q"), F.replace(u, F.lit("\\E"), F.lit("\\E\\\\E\\Q")),
                      F.lit("\\E"))
    prefix_re = F.concat(F.lit("^(?:"), quoted, F.lit(f"(?:{PY_SPACE_CLASS}+|$))+"))
    can_cut = u.isNotNull() & (u != "") & ~u.rlike(PY_SPACE_CLASS)

    def cut(ln: Column) -> Column:
        rest = F.regexp_replace(ln, prefix_re, F.lit(""))
        rejoined = F.regexp_replace(rest, f"{PY_SPACE_CLASS}+", " ")
        return F.when(can_cut & (rest != ln), rejoined).otherwise(ln)

    lines = F.transform(lines, cut)
    lines = F.filter(lines, lambda ln: (ln != "") & ~ln.rlike(RELATIVE_TIME_RE))
    return F.when(t.isNull() | (t == ""), t).otherwise(F.array_join(lines, "\n"))


__all__ = [
    "preprocess_text", "tokenize", "words", "remove_stopwords", "lower_tokens",
    "flatten_text", "clean_post_text",
]
