"""Text expressions: tokens, phrases and display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kindred.fixed import DROPPED_CHARS, LINE_MARK, SHOWN_LINE_MARK

# What counts as white space at the ends of a text.
# trim() alone removes blanks only.
WHITE_SPACE = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(text: Column | str) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.btrim(_col(text), F.lit(WHITE_SPACE))


def tokens(text: Column | str) -> Column:
    """Normalised words. Blanks in a row yield empty words, which count."""
    flat = F.replace(_col(text), F.lit(LINE_MARK), F.lit(" "))
    bare = F.translate(strip(F.lower(flat)), DROPPED_CHARS, "")
    return F.split(bare, " ", -1)


def paragraph_tokens(text: Column | str) -> Column:
    """Words of the last paragraph, case and punctuation kept."""
    return F.split(last_paragraph(text), " ", -1)


def last_paragraph(text: Column | str) -> Column:
    """The text after the last line mark."""
    return F.substring_index(_col(text), LINE_MARK, -1)


def phrase_count(words: Column | str) -> Column:
    """How many contiguous phrases a word list has, repeats included."""
    n = F.size(_col(words)).cast("long")
    return (n * (n + 1) / 2).cast("long")


def phrases(words: Column | str) -> Column:
    """Every contiguous phrase, by start then by length.

    Quadratic in the text: meant for short texts and for inspection.  Overlap
    counts never expand it (see ``kindred.operators.overlap``).
    """
    w = _col(words)
    n = F.size(w)
    return F.flatten(
        F.transform(
            F.sequence(F.lit(1), n),
            lambda i: F.transform(
                F.sequence(F.lit(1), n - i + 1),
                lambda length: F.array_join(F.slice(w, i, length), " "),
            ),
        )
    )


def display_text(text: Column | str) -> Column:
    """Text with line marks shown as dashes."""
    return F.replace(_col(text), F.lit(LINE_MARK), F.lit(SHOWN_LINE_MARK))


def matches(
    text: Column | str,
    term: str,
    *,
    regex: bool = False,
    ignore_case: bool = False,
) -> Column:
    """Does the text hold the term? Null text never does."""
    c = _col(text)
    if regex:
        hit = c.rlike(("(?iu)" if ignore_case else "") + term)
    elif ignore_case:
        hit = F.lower(c).contains(term.lower())
    else:
        hit = c.contains(term)
    return F.coalesce(hit, F.lit(False))
