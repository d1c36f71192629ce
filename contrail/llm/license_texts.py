"""Known license texts and notices (fixed values: the public wording of each license; the long ones in ``licenses``)."""

from importlib import resources

_MIT = """MIT License

Copyright (c) <year> <holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_CLAUSES = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
)
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def _file(name: str) -> str:
    return resources.files("contrail.llm").joinpath("licenses", f"{name}.txt").read_text("utf-8")


def _bsd(clauses: int) -> list[str]:
    """Clauses numbered or behind bullets; the usual wordings for contributors, holders and author."""
    out = []
    for mark in ("{}. ", "* "):
        body = "\n\n".join([_BSD_HEAD, *(mark.format(k) + c for k, c in enumerate(_BSD_CLAUSES[:clauses], 1)), _BSD_TAIL])
        for text in (body, body.replace("names of its contributors", "names of contributors")):
            out += [text, text.replace("SHALL THE COPYRIGHT HOLDER OR", "SHALL THE COPYRIGHT HOLDERS OR"),
                    text.replace("SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE", "SHALL <COPYRIGHT HOLDER> BE"),
                    text.replace("THE COPYRIGHT HOLDERS AND", "THE AUTHOR AND").replace("THE COPYRIGHT HOLDER OR", "THE AUTHOR OR")]
    return list(dict.fromkeys(out))


def _titled(license_id: str, bodies: list[str], *titles: str) -> list[tuple[str, str]]:
    """Each body without and with each title."""
    return [(license_id, f"{title}\n\n{body}" if title else body) for body in bodies for title in ("", *titles)]


def _parts(license_id: str, starts: tuple[str, ...], ends: tuple[str, ...] = ()) -> list[tuple[str, str]]:
    """A long text whole and from each of ``starts`` on (what stands before is title), to its end or to one of ``ends``."""
    text = _file(license_id)
    tops = [0, *(text.index(s) for s in starts)]
    stops = [len(text), *(text.index(e) for e in ends)]
    return [(license_id, text[a:b]) for a in tops for b in stops]


def _gnu(license_id: str, *starts: str) -> list[tuple[str, str]]:
    """With and without title and notice, and how to apply the terms; both addresses of the foundation."""
    text = _file(license_id)
    end = "END OF TERMS AND CONDITIONS"
    apply = text.find("How to Apply These Terms", text.find(end) + 1) if end in text else -1
    found = _parts(license_id, starts, (end, text[apply - 40:apply + 40]) if apply >= 0 else ())
    new, old = "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA"
    moved = [(i, " ".join(t.split(" ")).replace("MA  0", "MA 0").replace("  USA", " USA").replace(new, old)) for i, t in found]
    return list(dict.fromkeys(found + moved))


_PERMITTED = "Everyone is permitted to copy"

#: whole licenses, with and without title
WHOLE = (
    ("MIT", _MIT),
    *_titled("MIT", [_MIT.split("\n\n", 2)[2]], "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
    *_titled("ISC", [_ISC, _ISC.replace("and/or distribute", "and distribute")], "ISC License", "The ISC License", "ISC License (ISC)"),
    *_titled("Zlib", [_ZLIB], "zlib License", "The zlib License", "The zlib/libpng License"),
    *_titled("BSD-2-Clause", _bsd(2), "BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License",
             "BSD License"),
    *_titled("BSD-3-Clause", _bsd(3), "BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License",
             "BSD License"),
    *_titled("BSD-3-Clause", [_file("BSD-3-Clause-Regents")]),
    *_parts("Apache-2.0", ("TERMS AND CONDITIONS FOR USE",), ("END OF TERMS", "APPENDIX: How to apply")),
    *_gnu("GPL-1.0", _PERMITTED, "Preamble"),
    *_gnu("GPL-2.0", _PERMITTED, "Preamble"),
    *_gnu("GPL-3.0", _PERMITTED, "Preamble"),
    *_gnu("LGPL-2.0", _PERMITTED, "Preamble"),
    *_gnu("LGPL-2.1", _PERMITTED, "Preamble"),
    *_gnu("LGPL-3.0", _PERMITTED, "This version of the GNU Lesser"),
    *_gnu("AGPL-3.0", _PERMITTED, "Preamble"),
    *_parts("MPL-2.0", ("1. Definitions",), ("Exhibit A - Source",)),
    *_titled("Unlicense", [t for _, t in _parts("Unlicense", (), ("For more information",))], "The Unlicense", "Unlicense"),
    *_titled("BSL-1.0", [t for _, t in _parts("BSL-1.0", ("Permission is hereby",))], "Boost Software License, Version 1.0"),
    *_parts("CC0-1.0", ("CC0 1.0 Universal", "CREATIVE COMMONS CORPORATION", "Statement of Purpose")),
)

#: (license_id, text): whole licenses first, then the Apache header and one-line notices
KNOWN = (
    *WHOLE,
    ("Apache-2.0", _APACHE_HEADER),
    ("MIT", "MIT License"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Distributed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
)
