"""Known licences, by SPDX identifier: whole texts and the notices that stand
for them. Fixed values; spelling, case, punctuation, line ends and copyright
lines are evened out before they are compared. Long texts lie as files in
``known_licenses``, named by identifier."""

import pkgutil

_MIT_GRANT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of
this software and associated documentation files (the "Software"), to deal in
the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of
the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS
FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER
IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""

_BSD_GRANT = """
Redistribution and use in source and binary forms, with or without modification,
are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or
other materials provided with the distribution.
"""

_BSD_NAMES = """
3. Neither the name of the copyright holder nor the names of its contributors may
be used to endorse or promote products derived from this software without
specific prior written permission.
"""

_BSD_WARRANTY = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR
ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON
ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""

_ISC_WARRANTY = """
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS
OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.
"""

_FILES = (
    "Apache-2.0 Artistic-1.0-Perl BSD-3-Clause BSL-1.0 CC0-1.0 GFDL-1.2-only GFDL-1.3-only GPL-1.0-only GPL-2.0-only "
    "GPL-3.0-only LGPL-2.0-only LGPL-2.1-only LGPL-3.0-only MPL-1.1 MPL-2.0 Unlicense Zlib"
).split()
# The title may be left out, and what follows the terms tells how to apply them.
_TITLES = {"CC0-1.0": "Creative Commons Legal Code\n"}
_LAST = "END OF TERMS AND CONDITIONS"
# Identifiers that the notices below do not name in a line of their own.
_SPDX = (
    "AGPL-3.0-only AGPL-3.0-or-later Artistic-1.0-Perl Artistic-2.0 BSL-1.0 0BSD CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0 EPL-2.0 "
    "GFDL-1.2-only GFDL-1.2-or-later GFDL-1.3-only GFDL-1.3-or-later GPL-1.0-only GPL-1.0-or-later GPL-2.0-or-later "
    "GPL-3.0-or-later LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later "
    "MPL-1.1 MPL-2.0 Unlicense Zlib"
).split()


def _whole(name: str) -> list[tuple[str, str]]:
    text = pkgutil.get_data(__package__, f"known_licenses/{name}.txt").decode()
    texts = [text, text.removeprefix(_TITLES.get(name, ""))]
    texts += [t[: t.index(_LAST) + len(_LAST)] for t in texts if _LAST in t]
    return [(name, t) for t in dict.fromkeys(texts)]


LICENSES = [
    ("MIT", _MIT_GRANT),
    ("MIT", "MIT License" + _MIT_GRANT),
    ("MIT", "The MIT License (MIT)" + _MIT_GRANT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("BSD-2-Clause", _BSD_GRANT + _BSD_WARRANTY),
    ("BSD-2-Clause", "BSD 2-Clause License" + _BSD_GRANT + _BSD_WARRANTY),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", _BSD_GRANT + _BSD_NAMES + _BSD_WARRANTY),
    ("BSD-3-Clause", "BSD 3-Clause License" + _BSD_GRANT + _BSD_NAMES + _BSD_WARRANTY),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies." + _ISC_WARRANTY,
    ),
    ("ISC", "SPDX-License-Identifier: ISC"),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted." + _ISC_WARRANTY,
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        'on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
        "the specific language governing permissions and limitations under the License.",
    ),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-only"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
]
LICENSES += [pair for name in _FILES for pair in _whole(name)]
LICENSES += [(name, f"SPDX-License-Identifier: {name}") for name in _SPDX]
