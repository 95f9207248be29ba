"""Templates of license texts and notices: mandatory wording, optional and replaceable regions.

Words are what :mod:`opinarium.llm.licenses` takes as words, so punctuation, case, line breaks and
comment signs do not count, and digits of numbered lists are optional regions.
"""

from __future__ import annotations


def optional(wording: str) -> str:
    return f"<<beginOptional>>{wording}<<endOptional>>"


def replaceable(words: int) -> str:
    return f"<<var;words={words}>>"


# The wording of the public licenses.

MIT = f"""
permission is hereby granted free of charge to any person obtaining a copy of this {replaceable(3)} and
associated documentation files the {replaceable(3)} to deal in the {replaceable(3)} without restriction
including without limitation the rights to use copy modify merge publish distribute sublicense and or sell
copies of the {replaceable(3)} and to permit persons to whom the {replaceable(3)} is furnished to do so
subject to the following conditions the above copyright notice and this permission notice
{optional("including the next paragraph")} shall be included in all copies or substantial portions of the
{replaceable(3)} the {replaceable(3)} is provided as is without warranty of any kind express or implied
including but not limited to the warranties of merchantability fitness for a particular purpose and
noninfringement in no event shall the {replaceable(8)} be liable for any claim damages or other liability
whether in an action of contract tort or otherwise arising from out of or in connection with the
{replaceable(3)} or the use or other dealings in the {replaceable(3)}
"""

ISC = f"""
permission to use copy modify and {optional("or")} distribute this software {optional("and its documentation")}
for any purpose with or without fee is hereby granted provided that the above copyright notice and this
permission notice appear in all copies the software is provided as is and {replaceable(8)} disclaims all
warranties with regard to this software including all implied warranties of merchantability and fitness in no
event shall {replaceable(8)} be liable for any special direct indirect or consequential damages or any damages
whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other
tortious action arising out of or in connection with the use or performance of this software
"""

_BSD_START = f"""
redistribution and use {optional("of this software")} in source and binary forms {optional("of " + replaceable(4))}
with or without modification are permitted provided that the following conditions are met
"""
_BSD_SOURCE = """
redistributions of source code must retain the above copyright notice this list of conditions and the following
disclaimer
"""
_BSD_BINARY = """
redistributions in binary form must reproduce the above copyright notice this list of conditions and the
following disclaimer in the documentation and or other materials provided with the distribution
"""
_BSD_ADVERTISING = f"""
all advertising materials mentioning features or use of this software must display the following
acknowledgement this product includes software developed by {replaceable(12)}
"""
_BSD_NAMES = f"""
neither the name {optional("names")} of {replaceable(10)} nor the names of its {optional("their")} contributors
may be used to endorse or promote products derived from this software without specific prior written permission
"""
_BSD_END = f"""
this software is provided by {replaceable(10)} as is and any express or implied warranties including but not
limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no
event shall {replaceable(10)} be liable for any direct indirect incidental special exemplary or consequential
damages including but not limited to procurement of substitute goods or services loss of use data or profits or
business interruption however caused and on any theory of liability whether in contract strict liability or tort
including negligence or otherwise arising in any way out of the use of this software even if advised of the
possibility of such damage
"""


def _numbered(*clauses: str) -> str:
    return " ".join(f"{optional(str(i + 1))} {clause}" for i, clause in enumerate(clauses))


APACHE_NOTICE = f"""
licensed {optional("to you")} under the apache license version 2.0 the license you may not use this
{replaceable(3)} except in compliance with the license you may obtain a copy of the license at
{optional("http www.apache.org licenses license 2.0")} {optional("https www.apache.org licenses license 2.0")}
unless required by applicable law or agreed to in writing software distributed under the license is distributed
on an as is basis without warranties or conditions of any kind either express or implied see the license for the
specific language governing permissions and limitations under the license
"""


def _gnu_notice(kind: str, version: str) -> str:
    return f"""
{replaceable(4)} is free software you can redistribute it and or modify it under the terms of the gnu {kind}
general public license as published by the free software foundation {optional("either")} version {version}
of the license {optional("or at your option any later version")} {replaceable(6)} is distributed in the hope
that it will be useful but without any warranty without even the implied warranty of merchantability or fitness
for a particular purpose see the gnu {kind} general public license for more details
"""


def _notice_of_program(kind: str, version: str) -> str:
    """The notice with its usual opening word; a template begins with wording."""
    return "this " + _gnu_notice(kind, version).strip()


ZLIB = f"""
this software is provided as is without any express or implied warranty in no event will the {replaceable(4)} be
held liable for any damages arising from the use of this software permission is granted to anyone to use this
software for any purpose including commercial applications and to alter it and redistribute it freely subject to
the following restrictions {optional("1")} the origin of this software must not be misrepresented you must not
claim that you wrote the original software if you use this software in a product an acknowledgment in the product
documentation would be appreciated but is not required {optional("2")} altered source versions must be plainly
marked as such and must not be misrepresented as being the original software {optional("3")} this notice may not
be removed or altered from any source distribution
"""

MPL_NOTICE = """
this source code form is subject to the terms of the mozilla public license v 2.0 if a copy of the mpl was not
distributed with this file you can obtain one at
"""

WHOLE_TEXTS = {
    "mit-text": MIT,
    "isc": ISC,
    "bsd-2-clause": _BSD_START + _numbered(_BSD_SOURCE, _BSD_BINARY) + _BSD_END,
    "bsd-3-clause": _BSD_START + _numbered(_BSD_SOURCE, _BSD_BINARY, _BSD_NAMES) + _BSD_END,
    "bsd-4-clause": _BSD_START + _numbered(_BSD_SOURCE, _BSD_BINARY, _BSD_ADVERTISING, _BSD_NAMES) + _BSD_END,
    "zlib": ZLIB,
    "apache-2.0-notice": APACHE_NOTICE,
    "mpl-2.0-notice": MPL_NOTICE,
    "gpl-2.0-notice": _notice_of_program("", "2"),
    "gpl-3.0-notice": _notice_of_program("", "3"),
    "lgpl-2.1-notice": _notice_of_program("lesser", "2.1"),
    "lgpl-3.0-notice": _notice_of_program("lesser", "3"),
    "agpl-3.0-notice": _notice_of_program("affero", "3"),
}
