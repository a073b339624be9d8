"""Known licences: full texts, standard headers, and sentences that name a licence. Fixed values; all are public texts.

Not known in full, for want of a copy: AGPL-3.0, CC-BY-4.0 and the CC licences with NC or ND.
"""

import re
from importlib import resources

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

ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""

BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
BSD_3 = BSD_2.replace("\n\nTHIS SOFTWARE", f"\n\n{_THIRD}\n\nTHIS SOFTWARE")

UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org/>"""

# Texts too long for this module are files named by their licence.
FILES = ("Apache-2.0", "MPL-2.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-3.0-only", "CC0-1.0", "CC-BY-SA-4.0")


def _variants(name: str) -> list[tuple[str, str]]:
    """The text as it is handed on: with and without its appendix and the appendix' blank holder, with both schemes."""
    text = resources.files(__package__).joinpath("license_files", f"{name}.txt").read_text(encoding="utf-8")
    terms, end, _ = text.partition("END OF TERMS AND CONDITIONS")
    cut = {text, terms, terms + end, re.sub(r"Copyright \[yyyy\].*", "", text)}
    cut |= {x.replace("https://", "http://") for x in cut}
    return [(name, x) for x in sorted(cut)]


APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
# the first words stand on a line of their own
_APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License");',
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    "The ASF licenses this file to You under the Apache License, Version 2.0",
    APACHE_HEADER,
    APACHE_HEADER.replace("http://", "https://"),
)
MPL_HEADER = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/."""
_MPL = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "License, v. 2.0. If a copy of the MPL was not distributed with this",
    MPL_HEADER,
    MPL_HEADER.replace("http://", "https://"),
)

GNU = (
    ("GPL-2.0", "General", "2"),
    ("GPL-3.0", "General", "3"),
    ("LGPL-3.0", "Lesser General", "3"),
    ("AGPL-3.0", "Affero General", "3"),
)


def gnu_headers(license_id: str, kind: str, version: str) -> list[tuple[str, str]]:
    found = []
    for what in ("program", "library", "software", "file"):
        rest = f"""This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} Public License for more details."""
        copy = f"You should have received a copy of the GNU {kind} Public License along with this {what}. If not, see"
        for which, terms in (
            ("or-later", f"either version {version} of the License, or (at your option) any later version."),
            ("only", f"version {version}."),
            ("only", f"version {version} of the License."),
        ):
            opening = f"""This {what} is free software: you can redistribute it and/or modify it under the terms of the
GNU {kind} Public License as published by the Free Software Foundation, {terms}"""
            ends = [f"\n\n{rest}\n\n{copy} <{scheme}://www.gnu.org/licenses/>." for scheme in ("http", "https")]
            found += [(f"{license_id}-{which}", opening + end) for end in ("", f"\n\n{rest}", *ends)]
    return found


CREATIVE = (
    ("CC-BY-4.0", "by", "Attribution"),
    ("CC-BY-SA-4.0", "by-sa", "Attribution-ShareAlike"),
    ("CC-BY-NC-4.0", "by-nc", "Attribution-NonCommercial"),
    ("CC-BY-ND-4.0", "by-nd", "Attribution-NoDerivatives"),
    ("CC-BY-NC-SA-4.0", "by-nc-sa", "Attribution-NonCommercial-ShareAlike"),
    ("CC-BY-NC-ND-4.0", "by-nc-nd", "Attribution-NonCommercial-NoDerivatives"),
)


def creative_headers(license_id: str, path: str, name: str) -> list[tuple[str, str]]:
    first = f"This work is licensed under a Creative Commons {name} 4.0 International License."
    first = [first, first.replace("under a ", "under the ")]
    seen = [
        f"To view a copy of this license, visit {scheme}://creativecommons.org/licenses/{path}/4.0/{end}"
        for scheme in ("http", "https")
        for end in ("", "legalcode")
    ]
    return [(license_id, x) for x in [*first, *seen, *(f"{a}\n{b}" for a in first for b in seen)]]


TEXTS = (
    ("MIT", MIT),
    ("MIT", "MIT License\n\n" + MIT),
    ("MIT", "The MIT License (MIT)\n\n" + MIT),
    ("ISC", ISC),
    ("ISC", "ISC License\n\n" + ISC),
    ("BSD-2-Clause", BSD_2),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + BSD_2),
    ("BSD-3-Clause", BSD_3),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + BSD_3),
    ("BSD-3-Clause", 'BSD 3-Clause "New" or "Revised" License\n\n' + BSD_3),
    ("Unlicense", UNLICENSE),
    *[x for name in FILES for x in _variants(name)],
    *[("Apache-2.0", x) for x in _APACHE],
    *[("MPL-2.0", x) for x in _MPL],
    *[x for row in GNU for x in gnu_headers(*row)],
    *[x for row in CREATIVE for x in creative_headers(*row)],
)

NAMED = (
    ("Apache-2.0", "the Apache License, Version 2.0"),
    ("MIT", "the MIT License"),
    ("ISC", "the ISC License"),
    ("BSD-2-Clause", "the BSD 2-Clause License"),
    ("BSD-3-Clause", "the BSD 3-Clause License"),
    ("GPL-2.0-only", "the GNU General Public License, version 2"),
    ("GPL-3.0-only", "the GNU General Public License, version 3"),
    ("LGPL-3.0-only", "the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0-only", "the GNU Affero General Public License, version 3"),
    ("MPL-2.0", "the Mozilla Public License, Version 2.0"),
    ("CC0-1.0", "CC0 1.0"),
    ("CC-BY-4.0", "CC BY 4.0"),
    ("CC-BY-SA-4.0", "CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
    ("CC-BY-ND-4.0", "CC BY-ND 4.0"),
    ("CC-BY-NC-SA-4.0", "CC BY-NC-SA 4.0"),
    ("CC-BY-NC-ND-4.0", "CC BY-NC-ND 4.0"),
    ("Apache-2.0", "the Apache License 2.0"),
    ("MPL-2.0", "the Mozilla Public License 2.0"),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("GPL-2.0-only", "the GNU General Public License v2.0"),
    ("GPL-3.0-only", "the GNU General Public License v3.0"),
    ("LGPL-3.0-only", "the GNU Lesser General Public License v3.0"),
    ("AGPL-3.0-only", "the GNU Affero General Public License v3.0"),
)

# Identifiers of the list of the Software Package Data Exchange.
SPDX = (
    *sorted({i for i, _ in NAMED}),
    "Unlicense",
    *[f"{i}-or-later" for i, _, _ in GNU],
)
# Identifiers without "only" are older names of it.
TEXTS += tuple((i, f"SPDX-License-Identifier: {x}") for i in SPDX for x in dict.fromkeys((i, i.removesuffix("-only"))))

SENTENCES = (
    "Licensed under {}.",
    "Released under {}.",
    "Distributed under {}.",
    "This work is licensed under {}.",
    "This software is licensed under {}.",
    "This project is licensed under {}.",
)
