"""Set-based HTML extraction with regular expressions (no per-row parser).

An element is addressed by tag plus one attribute value (``class`` or any
``attr="value"``); its inner HTML is taken up to the first closing tag of the
same name (nested same-name tags are not balanced).  Text = inner HTML with
``<br>`` -> newline, tags removed, and named and numeric entities decoded (each
once, so ``&amp;lt;`` gives ``&lt;``).
"""

from __future__ import annotations

from dataclasses import dataclass
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Named entities: Python's HTML table; a no-break space reads as a space, and
# ``&apos;`` is not in that table.
ENTITIES = {k: chr(v) for k, v in name2codepoint.items()} | {"nbsp": " ", "apos": "'"}


@dataclass(frozen=True)
class Selector:
    tag: str = "[a-zA-Z0-9]+"
    attr: str | None = None
    value: str | None = None

    def pattern(self) -> str:
        tag = self.tag
        if self.attr is None:
            open_tag = f"<({tag})(?:\\s[^>]*)?>"
        else:
            open_tag = f"<({tag})\\s[^>]*{_esc(self.attr)}=\"{_esc(self.value)}\"[^>]*>"
        # group 1 = tag name, group 2 = inner html up to the first close of that
        # tag; a concrete tag name closes literally (no back-reference needed).
        close = f"</{tag}>" if tag.isalnum() else "</\\1>"
        return f"(?s){open_tag}(.*?){close}"


def _esc(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\/" else ch for ch in s)


def css(cls: str, tag: str = "[a-zA-Z0-9]+") -> Selector:
    return Selector(tag=tag, attr="class", value=cls)


def element_inner(html: Column, sel: Selector) -> Column:
    """Inner HTML of the first matching element, NULL when absent."""
    pat = sel.pattern()
    return F.when(html.rlike(pat), F.regexp_extract(html, pat, 2))


def html_to_text(inner: Column) -> Column:
    t = F.regexp_replace(inner, r"(?i)<br\s*/?>", "\n")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", "")
    return F.when(t.contains("&"), decode_entities(t)).otherwise(t)


def decode_entities(text: Column) -> Column:
    """Named (``&uuml;``), decimal (``&#8211;``) and hexadecimal (``&#x2013;``)
    references; anything else after ``&`` stays as it is."""
    table = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])

    def decoded(part: Column) -> Column:
        ref = F.regexp_extract(part, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)
        digits = F.regexp_replace(ref, "^#[xX]?", "")
        point = F.when(F.lower(F.substring(ref, 2, 1)) == "x", F.conv(digits, 16, 10)) \
            .otherwise(digits).try_cast("int")
        valid = ref.startswith("#") & (point > 0) & (point <= 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
        # a code point is four big-endian bytes
        number = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, point).otherwise(63)), 8, "0")), "UTF-32")
        char = F.when(valid, F.when(point == 160, " ").otherwise(number)).otherwise(
            F.when(~ref.startswith("#"), F.try_element_at(table, ref)))
        rest = F.substring(part, F.length(ref) + 2, F.length(part))
        return F.when((ref != "") & char.isNotNull(), F.concat(char, rest)).otherwise(F.concat(F.lit("&"), part))

    parts = F.split(text, "&")
    return F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(decoded(p))), "")


def block_text(html: Column, sel: Selector) -> Column:
    """Text of the first matching element (NULL when absent)."""
    return html_to_text(element_inner(html, sel))
