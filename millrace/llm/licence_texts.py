"""Known licences: whole texts and one-line notices."""

from pathlib import Path

# The public texts of the licences, without their copyright lines.
MIT = """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""

ISC = """ISC License

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
"""

ZERO_BSD = """BSD Zero Clause License

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
"""

BSD_2 = """BSD 2-Clause License

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""

APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""

LICENCES = [
    ("0BSD", ZERO_BSD),
    ("Apache-2.0-notice", APACHE_NOTICE),
    ("BSD-2-Clause", BSD_2),
    ("ISC", ISC),
    ("MIT", MIT),
]

BSD_3 = BSD_2.replace("2-Clause", "3-Clause").replace(
    "\nTHIS SOFTWARE IS",
    """
3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software without
   specific prior written permission.

THIS SOFTWARE IS""",
    1,
)


def full_texts() -> list[tuple[str, str]]:
    """(license_id, text) of published whole texts: the files beside this module, named by id."""
    files = sorted((Path(__file__).parent / "licence_data").glob("*.txt"))
    return [("BSD-3-Clause", BSD_3), *[(f.name.removesuffix(".txt"), f.read_text()) for f in files]]


# Titles under which the short texts are published.
TITLES = {
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License", "FreeBSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License", "Modified BSD License", "BSD License"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License"],
}
# Lines with which the terms end, or with which begins what follows them.
END_OF_TERMS = ("END OF TERMS AND CONDITIONS", "The End")
APPENDICES = (
    "Appendix: How to Apply These Terms",
    "How to Apply These Terms",
    "ADDENDUM: How to use this License",
    "Exhibit A - Source Code Form License Notice",
    "EXHIBIT A -Mozilla Public License",
)


def without_appendix(text: str) -> list[str]:
    """The text up to the end of its terms, with and without the line that says so."""
    lines = text.splitlines()
    out = []
    for i, line in enumerate(lines):
        if line.strip() in END_OF_TERMS:
            out += ["\n".join(lines[: i + 1]), "\n".join(lines[:i])]
        elif line.strip().startswith(APPENDICES):
            out.append("\n".join(lines[:i]))
    return out


def forms(license_id: str, text: str) -> list[str]:
    """The text in the forms it is usually found in: whole, without title, under other
    titles, and without appendix."""
    out = [text]
    if titles := TITLES.get(license_id):
        first, _, rest = text.strip().partition("\n")
        body = rest if first.strip() in titles else text
        out += [body, *(f"{title}\n\n{body}" for title in titles)]
    return list(dict.fromkeys([*out, *(cut for t in out for cut in without_appendix(t))]))


def known_forms() -> list[tuple[str, str]]:
    """(license_id, text) of all known licences in all forms."""
    return [(i, form) for i, text in [*LICENCES, *full_texts()] for form in forms(i, text)]


# Lines by which a document names its licence.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
]

# Names of licences in further usual notices.
NAMES = {
    "0BSD": ["BSD Zero Clause License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU GPL v2", "GNU General Public License v2.0"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU GPL v3", "GNU General Public License v3.0"],
    "ISC": ["ISC License"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3"],
    "MIT": ["MIT License"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"],
}
OPENINGS = ["Licensed under", "Released under", "Distributed under", "This work is licensed under", "This project is licensed under"]
MORE_NOTICES = [
    *[(i, f"{opening}{the} {name}") for i, names in NAMES.items() for name in names for opening in OPENINGS for the in ("", " the")],
    *[(i, f"SPDX-License-Identifier: {i}") for i in NAMES],
]

# Spellings that count as one, as published licence-matching guidelines have them.
SPELLINGS = [
    ("licence", "license"),
    ("analyse", "analyze"),
    ("authoris", "authoriz"),
    ("catalogue", "catalog"),
    ("centre", "center"),
    ("favour", "favor"),
    ("fulfilment", "fulfillment"),
    ("honour", "honor"),
    ("initialis", "initializ"),
    ("judgement", "judgment"),
    ("labour", "labor"),
    ("maximis", "maximiz"),
    ("minimis", "minimiz"),
    ("optimis", "optimiz"),
    ("organis", "organiz"),
    ("recognis", "recogniz"),
    ("utilis", "utiliz"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("noncommercial", "non commercial"),
    ("sub license", "sublicense"),
    ("copyright owner", "copyright holder"),
    ("https", "http"),
]
