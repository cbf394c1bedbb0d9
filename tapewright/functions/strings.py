"""Column functions on strings.  White space means every Unicode space."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tapewright.dims import ARCHIVE_ROOT

# The code points that count as white space, and ASCII punctuation.
SPACES = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Link patterns.
DOCUMENT_LINK = r"""(?i)href=["']([^"']*\.(?:htm|txt))["']"""
ANY_LINK = r"""(?i)href=["']([^"']*)["']"""


def blanked(c: Column, characters: str = SPACES) -> Column:
    """Each of the characters becomes a blank (cheaper than a regular expression)."""
    return F.translate(c, characters, " " * len(characters))


def squash(c: Column) -> Column:
    """Every run of white space becomes one blank."""
    return F.regexp_replace(blanked(c), " {2,}", " ")


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(SPACES))


def or_default(c: Column, default) -> Column:
    return F.coalesce(c, F.lit(default))


def is_blank(c: Column) -> Column:
    return F.length(or_default(c, "")) == 0


def zero_pad(c: Column, width: int = 10) -> Column:
    """Left-pad with zeros; a longer value stays whole (``lpad`` would cut it)."""
    c = c.cast("string")
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def without_zeros(c: Column) -> Column:
    """The digits without leading zeros; NULL when there is anything but digits."""
    return c.try_cast("bigint").cast("string")


def archive_url(cik: Column, accession: Column, document: Column, root: str = ARCHIVE_ROOT) -> Column:
    """Address of a filing document, NULL when the filing names none."""
    url = F.concat_ws(
        "/", F.lit(root), without_zeros(cik), F.replace(accession, F.lit("-"), F.lit("")), document
    )
    return F.when(~is_blank(document), url)


def clip(c: Column, n: int | None) -> Column:
    return c if n is None else F.substring(c, 1, n)


def clip_marked(c: Column, n: int, mark: str = "...") -> Column:
    """First ``n`` characters, followed by ``mark`` when all ``n`` were filled."""
    head = F.substring(or_default(c, ""), 1, n)
    return F.when(F.length(head) == n, F.concat(head, F.lit(mark))).otherwise(head)


def contains_literal(c: Column, needle: str) -> Column:
    """Case-insensitive substring test; ``%`` and ``_`` stand for themselves."""
    return F.lower(c).contains(needle.lower())


def contains_wild(c: Column, needle: str) -> Column:
    """Case-insensitive LIKE; ``%`` and ``_`` in the needle are wildcards."""
    return F.lower(c).like(f"%{needle.lower()}%")


def links(html: Column, pattern: str = DOCUMENT_LINK) -> Column:
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(1))


def url_base(url: Column) -> Column:
    return F.regexp_replace(url, r"/[^/]*$", "")


def resolve(link: Column, page_url: Column) -> Column:
    """An absolute link as it is; any other below the page's folder."""
    return F.when(link.startswith("http"), link).otherwise(
        F.concat(url_base(page_url), F.lit("/"), link)
    )


def words(c: Column, strip_punct: bool = False) -> Column:
    """Lower-case words between white space, repeats and empty ones included."""
    text = F.lower(or_default(c, ""))
    return F.split(blanked(text, SPACES + PUNCTUATION if strip_punct else SPACES), " ")


def word_set(c: Column, strip_punct: bool = False) -> Column:
    """Distinct lower-case words between white space."""
    return F.array_distinct(F.array_remove(words(c, strip_punct), ""))
