"""Keys of joined parts, keys of letters, and long strings that can be read."""

from __future__ import annotations

import base64
import random
import string

import pytest

from opinarium.llm import secrets


def _spans(text):
    return [text[a:b] for a, b, _ in secrets.novel_spans(text)]


def _token(seed):
    choose = random.Random(seed)
    parts = [b'{"alg":"HS256","typ":"JWT"}', b'{"sub":"%d","iat":%d}' % (choose.getrandbits(60), choose.getrandbits(31)),
             choose.randbytes(32)]
    return ".".join(base64.urlsafe_b64encode(p).decode().rstrip("=") for p in parts)


@pytest.mark.parametrize("seed", range(20))
def test_a_signed_token_is_found_whole(seed):
    token = _token(seed)
    text = f"Authorization: Bearer {token}. More words follow."
    assert _spans(text) == [token]
    assert token.split(".")[2] not in secrets._masked(text, secrets.novel_spans(text))


def test_keys_of_letters_only():
    for seed in range(50):
        key = "".join(random.Random(seed).choices(string.ascii_letters, k=32))
        assert _spans(f"Authorization: bearer {key} and words") == [key]


@pytest.mark.parametrize("readable", [
    "com/articles/2024/03/some-long-readable-slug-of-a-page", "org/wiki/World_War_2_in_the_western_desert",
    "internationalization", "someLongCamelCaseIdentifierName", "docs/guides/security/rotation-of-keys",
    "SOME_LONG_CONSTANT_NAME_2", "2024-03-01/2024-04-01"])
def test_readable_strings_are_no_secrets(readable):
    for word in ("token", "secret", "bearer"):
        assert _spans(f"the {word} https://example.{readable} and words") == []
        assert _spans(f"the {word} {readable} and words") == []
