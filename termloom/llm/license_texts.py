"""Texts of public licences, and one-line notices that name one.

Long texts are files in ``licenses``, named by id, as published. Notices are made from ids, names and usual wordings.
"""

import re
from importlib.resources import files

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and \
associated documentation files (the "Software"), to deal in the Software without restriction, including without \
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the \
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"""
_MIT_NOTICE = """The above copyright notice and this permission notice shall be included in all copies or substantial \
portions of the Software."""
_MIT_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT \
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL \
THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, \
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE \
SOFTWARE."""

_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is \
hereby granted"""
_ISC_CONDITION = """, provided that the above copyright notice and this permission notice appear in all copies"""
_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE \
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, \
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER \
IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR \
PERFORMANCE OF THIS SOFTWARE."""

_BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided \
that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following \
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following \
disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or \
promote products derived from this software without specific prior written permission."""
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED \
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR \
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, \
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS \
OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, \
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF \
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be \
held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it \
and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If \
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not \
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in \
compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific \
language governing permissions and limitations under the License."""

LICENSES = [
    ("MIT", "\n".join([_MIT_GRANT, _MIT_NOTICE, _MIT_WARRANTY])),
    ("MIT", "\n".join(["The MIT License", _MIT_GRANT, _MIT_NOTICE, _MIT_WARRANTY])),
    ("MIT", "\n".join(["MIT License", _MIT_GRANT, _MIT_NOTICE, _MIT_WARRANTY])),
    ("MIT-0", "\n".join([_MIT_GRANT.removesuffix(", subject to the following conditions:") + ".", _MIT_WARRANTY])),
    ("ISC", "\n".join([_ISC_GRANT + _ISC_CONDITION + ".", _ISC_WARRANTY])),
    ("ISC", "\n".join(["ISC License", _ISC_GRANT + _ISC_CONDITION + ".", _ISC_WARRANTY])),
    ("0BSD", "\n".join([_ISC_GRANT + ".", _ISC_WARRANTY])),
    ("BSD-2-Clause", "\n".join([_BSD_START, _BSD_WARRANTY])),
    ("BSD-3-Clause", "\n".join([_BSD_START, _BSD_NAMES, _BSD_WARRANTY])),
    ("Zlib", _ZLIB),
    ("Apache-2.0", _APACHE_HEADER),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
]

# Names that notices give to a licence, beside its id.
NAMES = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache License v2", "Apache 2.0 License", "Apache 2.0", "Apache 2 License"],
    "MIT": ["MIT License", "MIT"],
    "MIT-0": ["MIT No Attribution License"],
    "ISC": ["ISC License"],
    "0BSD": ["Zero-Clause BSD License", "BSD Zero Clause License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "FreeBSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License", "Revised BSD License"],
    "Zlib": ["zlib License"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "Unlicense": ["Unlicense"],
    "WTFPL": ["WTFPL"],
    "NCSA": ["University of Illinois/NCSA Open Source License"],
    "OFL-1.1": ["SIL Open Font License, Version 1.1", "SIL Open Font License 1.1"],
    "Artistic-1.0-Perl": [],
    "Artistic-2.0": ["Artistic License 2.0"],
    "CC0-1.0": ["CC0 1.0", "CC0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal", "Creative Commons CC0 1.0 Universal License"],
}
_VERSIONED = {
    "GPL": (["GNU General Public License", "GNU GPL", "GPL"], ["1.0", "2.0", "3.0"]),
    "LGPL": (["GNU Lesser General Public License", "GNU LGPL", "LGPL"], ["2.1", "3.0"]),
    "AGPL": (["GNU Affero General Public License", "GNU AGPL", "AGPL"], ["3.0"]),
    "GFDL": (["GNU Free Documentation License", "GNU FDL", "GFDL"], ["1.2", "1.3"]),
    "MPL": (["Mozilla Public License", "MPL"], ["1.1", "2.0"]),
    "EPL": (["Eclipse Public License", "EPL"], ["1.0", "2.0"]),
}
_COMMONS = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
_LATER = ["or later", "or any later version"]
_VERBS = ["licensed", "released", "distributed"]
_SUBJECTS = ["", "this work is ", "this project is ", "this software is "]


def _names() -> dict[str, list[str]]:
    found = {name: list(others) for name, others in NAMES.items()}
    for family, (names, versions) in _VERSIONED.items():
        for version in versions:
            short = version.removesuffix(".0")
            numbers = dict.fromkeys([version, short])
            said = [f"{n}{of}{v}" for n in names for v in numbers for of in (", version ", " v", " ")]
            said += [f"{n}{v}" for n in names[-1:] for v in numbers] + [f"{family}v{v}" for v in numbers]
            key = f"{family}-{version}"
            found[key] = said + ([f"{key}-only"] if "G" in family else [])
            if "G" in family:
                found[f"{key}-or-later"] = [f"{s}, {later}" for s in said for later in _LATER] + [f"{key}+"]
    for code, name in _COMMONS.items():
        for version in ("3.0", "4.0"):
            place = "International" if version == "4.0" else "Unported"
            said = [f"CC {code} {version}", f"Creative Commons {code} {version}", f"Creative Commons {name} {version}"]
            found[f"CC-{code}-{version}"] = [f"{s}{p}" for s in said for p in ("", f" {place}")]
    return found


def notices() -> list[tuple[str, str]]:
    """(id, sentence) for every licence, name and usual wording."""
    rows = []
    for key, names in _names().items():
        tags = [key, *[n for n in names if n.startswith(key) and n != key and " " not in n]]
        rows += [(key, f"SPDX-License-Identifier: {tag}") for tag in tags]
        rows += [(key, f"License: {name}") for name in [key, *names]]
        for name in dict.fromkeys([key, *names]):
            for ending in ("",) if "license" in name.lower() else ("", " license"):
                objects = [f"the {name}{ending}", f"{name}{ending}"]
                objects += [f"a {name}{ending}"] if key.startswith("CC") else [f"the terms of the {name}{ending}"]
                rows += [(key, f"{s}{verb} under {o}") for s in _SUBJECTS for verb in _VERBS for o in objects]
    return rows


# Lines that the canonical form drops are left out of long texts, as a text of other line lengths would drop more or less.
_DROPPED = re.compile(r"(?im)^[ \t]*(copyright[ \t:]*(\(c\)|©|[0-9<{\[]|by )|\(c\)|©|all rights reserved)[^\n]*$")
_LIST_END = re.compile(r"(?i)END OF TERMS AND CONDITIONS")


def whole_texts() -> list[tuple[str, str]]:
    """(id, text) of the files: as published, with a paragraph per line, and each of these up to its appendix."""
    rows = []
    # Resources, not paths: the package may lie in a zip file.
    for file in sorted(files(__package__).joinpath("licenses").iterdir(), key=lambda f: f.name):
        if not file.name.endswith(".txt"):
            continue
        text = file.read_text("utf-8")
        key = file.name.removesuffix(".txt")
        flowing = "\n".join(" ".join(p.split()) for p in re.split(r"\n[ \t]*\n", text))
        for form in (text, flowing):
            end = _LIST_END.search(form)
            cuts = [len(form), *([end.start(), end.end()] if end else [])]
            # Marks are blanks in the canonical form; without them no other line break makes a copyright line of a "(c)".
            rows += [(key, re.sub(r"(?i)\((c)\)|©", r"\1", _DROPPED.sub("", form[:cut]))) for cut in cuts]
    return rows


def _plain(text: str) -> str:
    return " ".join(re.findall(r"[^\W_]+", text.lower()))


def _distinct(rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The first row of those that differ in case, marks and white space only."""
    found: dict[str, tuple[str, str]] = {}
    for key, text in rows:
        found.setdefault(_plain(text), (key, text))
    return list(found.values())


LICENSES = _distinct([*LICENSES, *whole_texts(), *notices()])

# What is replaced in canonical texts, in this order; blanks are word ends.
SPELLINGS = [
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non infringement", "noninfringement"),
    ("non commercial", "noncommercial"),
    ("https", "http"),
    ("per cent", "percent"),
    ("copyright owner", "copyright holder"),
    ("isation", "ization"),
    ("ising ", "izing "),
    ("ised ", "ized "),
    ("ise ", "ize "),
    ("favour", "favor"),
    ("honour", "honor"),
    ("behaviour", "behavior"),
    ("acknowledgement", "acknowledgment"),
    ("judgement", "judgment"),
    ("fulfil ", "fulfill "),
    ("wilful", "willful"),
    ("whilst", "while"),
    ("artefact", "artifact"),
    ("catalogue", "catalog"),
    ("centre", "center"),
    ("programme ", "program "),
]
