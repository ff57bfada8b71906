"""Tokenizer and stop words as Column expressions (JVM-side, codegen'd).

A token is a maximal run of Unicode letters, digits or underscore, taken from
the lower-cased text.  Java's and RE2's ``\\w`` are ASCII-only, so the class is
spelled out; it equals Python's Unicode ``\\w``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN_PATTERN = r"[\p{L}\p{N}_]+"

# The English stop-word list of the NLTK corpus (179 entries), in
# its published order.  Entries with an apostrophe can never equal a token.
ENGLISH_STOPWORDS: tuple[str, ...] = tuple("""
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in
out on off over under again further then once here there when where why how all
any both each few more most other some such no nor not only own same so than too
very s t can will just don don't should should've now d ll m o re ve y ain aren
aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven
haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't
shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split())


def index_text(title: Column | str | None, text: Column | str) -> Column:
    """Text that is indexed: ``title + ' ' + text`` with missing parts as ''."""
    t = F.coalesce(_col(title), F.lit("")) if title is not None else F.lit("")
    return F.concat(t, F.lit(" "), F.coalesce(_col(text), F.lit("")))


def token_array(text: Column | str) -> Column:
    """array<string> of lower-cased tokens, repeats and order kept."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(TOKEN_PATTERN), 0)


def drop_stopwords(tokens: Column, stopwords: Iterable[str] | None) -> Column:
    """Remove stop words inside the array (an InSet test per element, no join)."""
    words = _usable(stopwords)
    if not words:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(words))


def _usable(stopwords: Iterable[str] | None) -> list[str]:
    if stopwords is None:
        return []
    # Words with characters outside the token class can never match a token.
    import re
    pat = re.compile(r"^\w+$")
    return sorted({w.lower() for w in stopwords if pat.match(w)})


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def explode_nonempty(df, array_col, out: str, *keep):
    """Rows of ``df`` (columns ``keep``) times the elements of ``array_col``.

    ``explode`` makes the optimizer add a ``size(array) > 0`` filter below the
    generator, which evaluates an expensive array expression (tokenizing,
    HTML parsing) a second time.  ``explode_outer`` plus a null filter has the
    same result without the duplicate evaluation."""
    arr = F.col(array_col) if isinstance(array_col, str) else array_col
    return df.select(*keep, F.explode_outer(arr).alias(out)).filter(F.col(out).isNotNull())
