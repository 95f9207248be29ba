"""Keys that repeat, and keys of many lines."""

from __future__ import annotations

import base64
import random

import pytest

from opinarium.llm import secrets

KEY = "9fQ2vLx8Zr1TnB7kW0pYc3"


def _spans(text):
    return [text[a:b] for a, b, _ in secrets.novel_spans(text)]


@pytest.mark.parametrize("between", ["\n", " and ", "\n" + "plain words " * 40, "\n" + "plain words " * 170])
def test_repeated_keys_are_found_at_each_place(between):
    assert _spans(f"bearer {KEY}{between}bearer {KEY}") == [KEY, KEY]


@pytest.mark.parametrize("gap", range(2010, 2070))
def test_copies_on_the_edge_of_the_surrounding_text(gap):
    assert _spans(f"bearer {KEY}{' ' * gap}bearer {KEY}") == [KEY, KEY]


def test_repeated_keys_inside_longer_strings():
    assert _spans(f"token /one/{KEY} token /two/{KEY}") == [f"/one/{KEY}", f"/two/{KEY}"]


@pytest.mark.parametrize("size", [1190, 1191, 1192, 1200])
@pytest.mark.parametrize("newline", ["\n", "\r\n", "\n    ", "\\n"])
def test_a_private_key_is_found_whole(size, newline):
    code = base64.b64encode(random.Random(size).randbytes(size)).decode()
    body = newline.join(code[i:i + 64] for i in range(0, len(code), 64))
    text = f"-----BEGIN PRIVATE KEY-----{newline}{body}{newline}-----END PRIVATE KEY-----{newline}words"
    # Of a written-out line break before the first line, the n is read as part of the string.
    assert _spans(text) == ["n" * (newline == "\\n") + body]


def test_lines_behind_a_key_that_are_no_keys_stay():
    for line in ("-" * 30, "authorization_authentication", "words of a text", "short", f"{KEY} and words"):
        assert _spans(f"bearer {KEY}\n{line}\nmore") == [KEY] + ([KEY] if KEY in line else [])
