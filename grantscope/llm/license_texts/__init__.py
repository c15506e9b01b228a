"""Standard headers, SPDX lines and whole texts of common licences (fixed values), by identifier.

The AGPL's body is the GPL's with the name changed, close enough to tell the two apart.
"""

from __future__ import annotations

import pkgutil

_FREE = ("This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name}General Public License")
_WARRANTY = (" This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
             " MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name}General Public License for more details."
             " You should have received a copy of the GNU {name}General Public License along with this {what}. If not, see"
             " https://www.gnu.org/licenses/.")
_LATER = " as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version."
_GNU = tuple((i, text.format(what=what, name=name, v=v))
             for i, what, name, v in (("AGPL-3.0", "program", "Affero ", "3"), ("GPL-2.0", "program", "", "2"), ("GPL-3.0", "program", "", "3"),
                                      ("LGPL-2.1", "library", "Lesser ", "2.1"), ("LGPL-3.0", "library", "Lesser ", "3"))
             for text in (_FREE + ", version {v}.", _FREE + _LATER, _FREE + _LATER + _WARRANTY,
                          "Licensed under the GNU {name}General Public License, version {v}."))

_DISCLAIMED = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT"
    " LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE"
    " COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES"
    " (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)"
    " HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)"
    " ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD_GRANT = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
              " conditions are met:")
_BSD_TWO = (" 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
            " 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer"
            " in the documentation and/or other materials provided with the distribution.")
_BSD_THIRD = (" 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
              " derived from this software without specific prior written permission.")
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the"
    " \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,"
    " publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,"
    " subject to the following conditions:")
_MIT_REST = (
    " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE"
    " SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF"
    " MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE"
    " FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION"
    " WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that"
    " the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR"
    " DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT"
    " SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS"
    " OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH"
    " THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_APACHE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You"
    " may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0")
_APACHE_REST = (
    " Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS,"
    " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing"
    " permissions and limitations under the License.")
_MPL = ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with"
        " this file, You can obtain one at https://mozilla.org/MPL/2.0/.")

# A BSD grant alone does not tell the number of clauses; it is taken as the licence with more conditions.
HEADERS = (*_GNU, ("Apache-2.0", _APACHE), ("Apache-2.0", _APACHE + _APACHE_REST), ("BSD-2-Clause", _BSD_GRANT + _BSD_TWO + _DISCLAIMED),
           ("BSD-3-Clause", _BSD_GRANT), ("BSD-3-Clause", _BSD_GRANT + _BSD_TWO + _BSD_THIRD + _DISCLAIMED), ("ISC", _ISC),
           ("MIT", "Licensed under the MIT License."), ("MIT", _MIT_GRANT), ("MIT", _MIT_GRANT + _MIT_REST), ("MPL-2.0", _MPL))

_IDENTIFIERS = ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "ISC", "MIT", "MPL-2.0",
                "Unlicense")
_GNU_IDENTIFIERS = ("AGPL-3.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0")
SPDX = tuple((i, f"SPDX-License-Identifier: {i}{more}") for names, ends in ((_IDENTIFIERS, ("",)), (_GNU_IDENTIFIERS, ("", "-only", "-or-later")))
             for i in names for more in ends)


def _body(name: str) -> str:
    return pkgutil.get_data(__name__, f"{name}.txt").decode()


BODIES = (*((i, _body(i)) for i in ("Apache-2.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0")),
          ("AGPL-3.0", _body("GPL-3.0").replace("GNU General Public License", "GNU Affero General Public License").replace(
              "GNU GENERAL PUBLIC LICENSE", "GNU AFFERO GENERAL PUBLIC LICENSE")))
