"""Randomly damaged documents, against the verdict of Python's own XML parser."""

import random
import xml.etree.ElementTree as ElementTree

from conftest import SAMPLE, fragment

from cardweave import schemas as S
from cardweave.operators.parse import parse_feed

PIECES = [
    "<", ">", "/", "</", "/>", "<Data>", "</Data>", "<Data/>", "<x>", "</x>", "<x/>", "&", "&amp;", "&lt;", "&x;", "&#65;",
    "<!-- c -->", "<!--", "-->", "--", "<![CDATA[", "]]>", "<![CDATA[ <y> ]]>", "<?p i?>", "<?", "?>", '"', "'", "=", " ", "\n",
    " a='1'", ' a=">"', " xmlns='urn:x'", " xmlns:p='urn:x'", "p:", "<p:Amount xmlns:p='u'>9</p:Amount>", "Data", "data", "Amount", "amount", "﻿",
    '<?xml version="1.0"?>', "<Amount>1</Amount>", "<w_>", "</w_>", "\x01", "é", "<!DOCTYPE Data>", "junk", "\t",
]


def damaged(rng):
    text = rng.choice([SAMPLE, fragment(), "<Data/>", "<Data><TransactionId>1</TransactionId></Data>"])
    for _ in range(rng.choice([0, 1, 1, 1, 2, 3])):
        # Damage mostly falls where markup is.
        marks = [i for i, ch in enumerate(text) if ch in "<>/"] + [0, len(text)]
        at = min(len(text), rng.choice(marks) + rng.choice([0, 0, 1])) if rng.random() < 0.7 else rng.randint(0, len(text))
        kind = rng.random()
        if kind < 0.6:
            text = text[:at] + rng.choice(PIECES) + text[at:]
        elif kind < 0.8:
            text = text[:at] + text[at + rng.randint(1, 6) :]
        else:
            end = rng.randint(at, len(text))
            text = text[:end] + text[at:end] + text[end:]
    return text


def model(text):
    """The leaf texts of an acceptable document, else None."""
    if not text.strip() or "<!DOCTYPE" in text or text.startswith("﻿"):
        return None
    try:
        root = ElementTree.fromstring(text)
    except (ElementTree.ParseError, ValueError):
        return None
    if root.tag != "Data":
        return None
    leaves = {}
    for child in root:
        # Markup inside a leaf, and a leaf with a default namespace, are known differences.
        if child.tag.startswith("{") and child.tag.split("}")[1] in S.ELEMENTS and f":{child.tag.split('}')[1]}" not in text:
            leaves[child.tag.split("}")[1]] = ...
        if child.tag in S.ELEMENTS:
            leaves[child.tag] = (child.text or "") if len(child) == 0 else ...
    return leaves


def test_verdicts_agree(feed_of):
    rng = random.Random(11)
    texts = [damaged(rng) for _ in range(6000)]
    rows = parse_feed(feed_of(texts)).select("offset", "parsed", "transaction_id", "currency_code", "digital_pan").collect()
    got = {r["offset"]: r for r in rows}
    accepted = 0
    for i, text in enumerate(texts):
        leaves = model(text)
        row = got[i]
        assert row["parsed"] == (leaves is not None), text
        if leaves is None:
            continue
        accepted += 1
        for name, column in (("TransactionId", "transaction_id"), ("CurrencyCode", "currency_code"), ("DigitalPan", "digital_pan")):
            if leaves.get(name) is not ...:
                assert row[column] == leaves.get(name), text
    assert 1500 < accepted < 4500
