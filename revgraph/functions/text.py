"""Wiki markup as native Spark column expressions.

Every function maps ``Column -> Column`` (or ``DataFrame -> DataFrame``
where a Spark ML transformer is involved) so the work stays in the JVM and
can be used with ``select`` / ``df.transform``. Patterns use Java regex
semantics: ``.`` never crosses a line break, so markup spanning lines is left
in the text.
"""

from __future__ import annotations

import re

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# They must equal the original job's for identical results.
#   LINK_PATTERN      every [[...]] on one line, shortest match
#   CATEGORY_PATTERN  every [[Category:...]] on one line (case-sensitive)
#   MARKUP_PATTERN    markup removed before counting words, alternatives in
#                     this order: [[link]], <ref>..</ref>, <math>..</math>,
#                     `'''..'''`, ==..==, [..], '''..''', {{..}}
#   STRIPPED_CHARS    the 26 characters turned into one space each:
#                     . , ( ) [ ] newline { } ; ! ? " # : + * = / ' \ ~ | < > _
#   EXCLUDED_LINK     link target dropped (compared before lower-casing)
LINK_PATTERN = r"\[\[(.*?)\]\]"
CATEGORY_PATTERN = r"\[\[Category:(.*?)\]\]"
MARKUP_PATTERN = (
    r"(\[\[(.*?)\]\])|(<ref>(.*?)</ref>)|(<math>(.*?)</math>)|(`'''(.*?)'''`)"
    r"|(==(.*?)==)|(\[(.*?)\])|('''(.*?)''')|(\{\{(.*?)\}\})"
)
#: One test of a character before all alternatives: each begins with one of these.
MARKUP_START = r"(?=[\[<`='{])"
STRIPPED_CHARS = ".,()[]\n{};!?\"#:+*=/'\\~|<>_"
EXCLUDED_LINK = "category"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_links(text) -> Column:
    """Distinct, lower-cased link targets of the raw text, sorted.

    The target is the text before the first ``|``, then before the first
    ``#``, then before the first ``:``; a target that is exactly
    ``category`` is dropped (case-sensitive, before lower-casing) and so is
    the empty target.
    """
    inner = F.regexp_extract_all(_col(text), F.lit(LINK_PATTERN), 1)
    targets = F.transform(
        inner,
        lambda w: F.split_part(
            F.split_part(F.split_part(w, F.lit("|"), F.lit(1)), F.lit("#"), F.lit(1)),
            F.lit(":"),
            F.lit(1),
        ),
    )
    kept = F.filter(targets, lambda t: (t != F.lit(EXCLUDED_LINK)) & (t != F.lit("")))
    return F.array_sort(F.array_distinct(F.transform(kept, F.lower)))


def extract_categories(text) -> Column:
    """Distinct category names, case kept, text from the last ``|`` on removed."""
    names = F.regexp_extract_all(_col(text), F.lit(CATEGORY_PATTERN), 1)
    return F.array_sort(F.array_distinct(F.transform(names, lambda w: F.regexp_replace(w, r"\|[^|]*$", ""))))


def strip_markup(text) -> Column:
    """Remove links, references, formulas, headings, brackets, bold and templates."""
    return F.regexp_replace(_col(text), f"{MARKUP_START}(?:{MARKUP_PATTERN})", "")


def strip_chars(text) -> Column:
    """Replace each of the 26 punctuation characters by one space."""
    return F.translate(_col(text), STRIPPED_CHARS, " " * len(STRIPPED_CHARS))


def tokenize(text) -> Column:
    """E5: lower-case and split on single spaces (empty tokens kept)."""
    return F.split(F.lower(_col(text)), " ")


def title_key(title) -> Column:
    """Page key: lower case, space as underscore."""
    return F.translate(F.lower(_col(title)), " ", "_")


def revision_year(timestamp) -> Column:
    """The text before the first ``-`` of an ISO timestamp."""
    return F.substring_index(_col(timestamp), "-", 1)


def array_to_text(arr, sep: str = ",") -> Column:
    """Join an array with ``sep`` (export only)."""
    return F.concat_ws(sep, _col(arr))


def wordcount_text(wordcount, sep: str = ",") -> Column:
    """A word-count map as sorted ``word:n`` entries joined with ``sep``."""
    entries = F.transform(
        F.map_entries(_col(wordcount)),
        lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")),
    )
    return F.array_join(F.array_sort(entries), sep)


def remove_stop_words(df: DataFrame, input_col: str, output_col: str) -> DataFrame:
    """Spark ML's default English stop-word remover (case-insensitive).

    Kept as an element filter rather than a set difference, so repeated
    words survive and can be counted.
    """
    return StopWordsRemover(inputCol=input_col, outputCol=output_col).transform(df)


def words_from_kept(kept) -> Column:
    """E7 after stop words: re-join, strip markup and punctuation, split, drop ``""``."""
    joined = F.array_join(_col(kept), " ")
    # The words of ``split(strip_chars(...), " ")``, without a text in between.
    return F.filter(F.split(strip_markup(joined), f"[ {re.escape(STRIPPED_CHARS)}]+"), lambda w: w != F.lit(""))


def clean_words(df: DataFrame, text_col: str = "text", output_col: str = "words") -> DataFrame:
    """Tokenize -> stop words -> join -> strip markup -> strip chars -> split.

    The order matters: stop words are removed before markup and punctuation,
    so a token such as ``the,`` survives as the word ``the``.
    """
    tokens = f"_{output_col}_tokens"
    kept = f"_{output_col}_kept"
    out = df.withColumn(tokens, tokenize(text_col))
    out = remove_stop_words(out, tokens, kept)
    return out.withColumn(output_col, words_from_kept(kept)).drop(tokens, kept)
