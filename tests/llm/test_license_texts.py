"""Whole license texts: accepted as published, refused with altered wording."""

from __future__ import annotations

import re

import pytest

from opinarium.llm import arrays, licenses
from opinarium.llm.license_texts import WHOLE_TEXTS

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:
"""
CLAUSES = ["Redistributions of source code must retain the above copyright notice, this list of conditions and the "
           "following disclaimer.",
           "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
           "following disclaimer in the documentation and/or other materials provided with the distribution."]
ADVERTISING = ("All advertising materials mentioning features or use of this software must display the following "
               "acknowledgement: This product includes software developed by the Example Project.")
NAMES = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
         "products derived from this software without specific prior written permission.")
END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF
USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED
OF THE POSSIBILITY OF SUCH DAMAGE."""


def bsd(*more: str, sign: str = "{}. ") -> str:
    listed = [sign.format(i + 1) + clause for i, clause in enumerate([*CLAUSES, *more])]
    return "\n".join([START, *listed, "", END])


APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty
of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""


SCANNER = licenses.Scanner(licenses.BASE, licenses.TEMPLATES)


def labels(text: str) -> set[str]:
    return {m[2].label for m in SCANNER.scan(arrays.block_of([text]))[1][0]}


def commented(text: str) -> str:
    return "\n".join(f" * {line}" for line in text.split("\n"))


PUBLISHED = [
    (MIT, {"mit-text"}), (bsd(), {"bsd-2-clause"}), (bsd(NAMES), {"bsd-3-clause"}),
    (bsd(ADVERTISING, NAMES), {"bsd-4-clause"}), (bsd(NAMES, sign="* "), {"bsd-3-clause"}),
    (APACHE, {"apache", "apache-2.0", "apache-2.0-notice"}), (GPL, {"gpl", "gpl-3.0", "gpl-3.0-notice"}),
]


@pytest.mark.parametrize("text,expected", PUBLISHED)
def test_published_texts(text, expected):
    assert labels(text) == expected
    assert labels(f"Copyright 2020 Somebody\n\n{commented(text)}\n\nint main;") == expected


@pytest.mark.parametrize("text,changed", [
    (MIT, ("subject to the following conditions:", "provided you pay one million dollars and never redistribute")),
    (MIT, ("sublicense, ", "")), (MIT, ("OR OTHER LIABILITY", "OR OTHER CLAIMS")),
    (bsd(), ("following conditions are met:", "following conditions are met: you must never do so")),
    (bsd(NAMES), ("prior written", "prior")), (APACHE, ("or agreed to in writing", "")), (GPL, ("WITHOUT ANY", "WITH A"))])
def test_altered_wording_is_refused(text, changed):
    assert changed[0] in text
    assert not labels(text.replace(*changed)) & set(WHOLE_TEXTS)


@pytest.mark.parametrize("text,expected", PUBLISHED)
def test_every_word_outside_the_regions_counts(text, expected):
    """Without any one word, only a word of a region may be missing."""
    whole = expected & set(WHOLE_TEXTS)
    words = list(re.finditer(r"\w+", text))
    kept = [m[0] for m in words if labels(text[:m.start()] + text[m.end():]) & whole]
    assert len(kept) <= 0.2 * len(words)
    longer = [m[0] for m in words[1:] if labels(text[:m.start()] + "inserted " + text[m.start():]) & whole]
    assert len(longer) <= 0.2 * len(words)
