"""Strict reading of one XML fragment with ``from_xml``."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardweave import schemas as S

_WRAPPER = "w_"
_CORRUPT = "_corrupt_record"
_OTHERS = "_others"
_DOCUMENT = T.StructType(
    [
        T.StructField(S.ROOT, T.ArrayType(S.FRAGMENT)),
        T.StructField("_VALUE", T.StringType()),
        T.StructField(_OTHERS, T.ArrayType(T.StringType())),
        T.StructField(_CORRUPT, T.StringType()),
    ]
)
_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _CORRUPT,
    "ignoreSurroundingSpaces": "false",
    "valueTag": "_VALUE",
    "wildcardColName": _OTHERS,
}

# All quantifiers that can meet long text are possessive: no recursion, no backtracking.
_QUOTED = r'''"[^"]*+"|'[^']*+\''''
_PROLOG = (
    r"""\A<\?xml\s++version\s*+=\s*+(?:"1\.[0-9]++"|'1\.[0-9]++')"""
    rf"""(?:\s++encoding\s*+=\s*+(?:{_QUOTED}))?+"""
    rf"""(?:\s++standalone\s*+=\s*+(?:{_QUOTED}))?+\s*+\?>"""
)
_MISC = r"(?:[ \t\r\n]++|<!--(?:[^-]++|-(?!-))*+-->|<\?(?:[^?]++|\?(?!>))*+\?>)*+"
_DEFAULT_NAMESPACE = r"""xmlns\s*+=\s*+(?:"[^"]|'[^'])"""
_START = (
    rf"\A{_MISC}<{S.ROOT}"
    rf"(?!(?:[^>\"'\s]++|{_QUOTED}|\s++(?!{_DEFAULT_NAMESPACE}))*+\s++{_DEFAULT_NAMESPACE})"
    r"[ \t\r\n/>]"
)

# Content that holds no tag, and a "<" that does not open one of the tags looked for.
_CDATA = r"<!\[CDATA\[(?:[^\]]++|\](?!\]>))*+\]\]>"
_COMMENT = r"<!--(?:[^-]++|-(?!->))*+-->"
_INSTRUCTION = r"<\?(?:[^?]++|\?(?!>))*+\?>"
_NO_TAG = rf"[^<]++|{_CDATA}|{_COMMENT}|{_INSTRUCTION}"


def _every_tag(opening: str, rest: str = "") -> str:
    """Matches up to and with the next tag that starts with ``opening`` and goes on with ``rest``.

    Group 1 is what lies before, those of ``opening`` follow. Matches follow each other without
    a gap, so names inside CDATA sections, comments and instructions are never taken for tags.
    """
    plain = re.sub(r"(?<!\\)\((?!\?)", "(?:", opening)
    return rf"\G((?:{_NO_TAG}|<(?!{plain}))*+)<{opening}{rest}"


# A known name in other letter case (which a session may ignore) or behind a namespace
# prefix (which from_xml ignores) is an unknown element: it gets an underscore in front.
_NAMES = "|".join(S.ELEMENTS)
_INITIALS = "".join(sorted({name[0] for name in S.ELEMENTS}))
_LOOKALIKE = (
    rf"(/?+)(?!(?:{_NAMES}|{S.ROOT})[\s/>])"
    r"""(?:([^\s<>/:"'=&]++:)"""
    rf"|(?=[{_INITIALS}{_INITIALS.lower()}]))(?=(?i:{_NAMES})[\s/>])"
)

# So is a known name with a default namespace of its own, up to its end tag.
_ATTRIBUTE = rf"""\s++[^\s=<>/"']++\s*+=\s*+(?:{_QUOTED})"""
_IN_NAMESPACE = (
    rf"(?=(?:{_NAMES})(?:(?!\s++{_DEFAULT_NAMESPACE}){_ATTRIBUTE})*+\s++{_DEFAULT_NAMESPACE})"
    rf"({_NAMES})((?:{_ATTRIBUTE})++\s*+)"
)
_FILLED = rf">((?:{_NO_TAG}|<(?!/?+\2[\s/>]))*+)</\2(?=\s*+>)"


def _unknown_marked(body: Column) -> Column:
    """The text with an underscore before the names of elements that only look like known ones."""
    marked = F.when(body.rlike("<" + _LOOKALIKE), F.regexp_replace(body, _every_tag(_LOOKALIKE), "$1<$2$3_"))
    marked = marked.otherwise(body)
    empty = F.regexp_replace(marked, _every_tag(_IN_NAMESPACE + "(?=/>)"), "$1<_$2$3")
    filled = F.regexp_replace(empty, _every_tag(_IN_NAMESPACE + "(?=>)", _FILLED), "$1<_$2$3>$4</_$2")
    return F.when(body.contains("xmlns") & body.rlike(rf"<(?:{_NAMES})\s[^<]*?xmlns"), filled).otherwise(marked)


def fragment_text(value: Column) -> Column:
    """The text to parse: without its prolog, unknown elements marked; null when the first tag is not the root."""
    body = F.when(value.startswith("<?xml"), F.regexp_replace(value, _PROLOG, "")).otherwise(value)
    return F.when(body.rlike(_START), _unknown_marked(body))


def read_fragment(text: Column) -> Column:
    """Parse one ``fragment_text`` whose root must be the fragment's root, without namespace.

    ``from_xml`` alone takes any root, trailing text and a second root. So the text is
    tested for its first tag, then parsed inside a wrapper element, where stray text and
    elements show up beside the root. Text that fails the test is not parsed at all.
    """
    # A text that closes the wrapper itself gets one whose name it cannot know.
    name = F.when(text.contains(f"</{_WRAPPER}"), F.concat(F.lit(_WRAPPER), F.sha2(text, 256))).otherwise(_WRAPPER)
    wrapped = F.concat(F.lit("<"), name, F.lit(">"), text, F.lit("</"), name, F.lit(">"))
    return F.from_xml(wrapped, _DOCUMENT, _OPTIONS)


def is_accepted(document: Column) -> Column:
    stray = document["_VALUE"]
    return F.coalesce(
        document[_CORRUPT].isNull()
        & (F.size(document[S.ROOT]) == 1)
        & document[_OTHERS].isNull()
        & (stray.isNull() | stray.rlike(r"\A[ \t\r\n]*+\z")),
        F.lit(False),
    )


def element(document: Column, name: str) -> Column:
    return F.get(document[S.ROOT], F.lit(0))[name]
