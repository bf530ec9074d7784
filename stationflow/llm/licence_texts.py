"""What licence families are known by: names, short identifiers and their own words."""

from __future__ import annotations

from typing import NamedTuple


class Licence(NamedTuple):
    names: tuple[str, ...]
    ids: tuple[str, ...]
    texts: tuple[str, ...] = ()


# Public licence texts and notices, as their authors give them.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""
_APACHE_TERMS = """Apache License Version 2.0, January 2004 http://www.apache.org/licenses/

TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION

Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor hereby grants to You a
perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare
Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works
in Source or Object form."""
_GNU = """This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as
published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.

This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details.

You should have received a copy of the GNU {name} along with this {thing}. If not, see <https://www.gnu.org/licenses/>."""
_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors."""
_BOOST = """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software
is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and
the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works
of the Software, unless such copies or derivative works are solely in the form of machine-executable object code
generated by a source language processor."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
_CC0 = """To the extent possible under law, the author has waived all copyright and related or neighboring rights to this
work."""
_EPL = """This program and the accompanying materials are made available under the terms of the Eclipse Public License
2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"""


def _gnu(name: str, versions: tuple[str, ...], things: tuple[str, ...] = ("program",)) -> tuple[str, ...]:
    notices = tuple(_GNU.format(thing=t, name=name, version=v) for v in versions for t in things)
    return notices + tuple(f"GNU {name.upper()} Version {v}" for v in versions)


_CC = "Creative Commons Attribution"
LICENCES = {
    "apache-2.0": Licence(("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"), ("Apache-2.0",), (_APACHE, _APACHE_TERMS)),
    "mit": Licence(("MIT License", "MIT license (MIT)"), ("MIT",), (_MIT,)),
    "gpl-3.0": Licence(
        ("GNU General Public License, version 3", "GNU GPL v3", "GPLv3"), ("GPL-3.0-only", "GPL-3.0-or-later"),
        _gnu("General Public License", ("3",)),
    ),
    "gpl-2.0": Licence(
        ("GNU General Public License, version 2", "GNU GPL v2", "GPLv2"), ("GPL-2.0-only", "GPL-2.0-or-later"),
        _gnu("General Public License", ("2",)),
    ),
    "lgpl": Licence(
        ("GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License, version 3", "GNU LGPL v3", "GNU LGPL v2.1"),
        ("LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later"),
        _gnu("Lesser General Public License", ("2.1", "3"), ("library", "program")),
    ),
    "agpl-3.0": Licence(
        ("GNU Affero General Public License, version 3", "GNU AGPL v3"), ("AGPL-3.0-only", "AGPL-3.0-or-later"),
        _gnu("Affero General Public License", ("3",)),
    ),
    "bsd": Licence(("BSD 3-Clause License", "BSD 2-Clause License", "BSD License", "new BSD license"), ("BSD-3-Clause", "BSD-2-Clause"), (_BSD,)),
    "mpl-2.0": Licence(("Mozilla Public License, v. 2.0", "Mozilla Public License Version 2.0"), ("MPL-2.0",), (_MPL,)),
    "epl-2.0": Licence(("Eclipse Public License 2.0", "Eclipse Public License, version 2.0"), ("EPL-2.0",), (_EPL,)),
    "isc": Licence(("ISC License",), ("ISC",), (_ISC,)),
    "boost": Licence(("Boost Software License, Version 1.0", "Boost Software License 1.0"), ("BSL-1.0",), (_BOOST,)),
    "zlib": Licence(("zlib License", "zlib/libpng License"), ("Zlib",), (_ZLIB,)),
    "cc-by": Licence(("CC BY 4.0", f"{_CC} 4.0 International License"), ("CC-BY-4.0",)),
    "cc-by-sa": Licence(("CC BY-SA 4.0", f"{_CC}-ShareAlike 4.0 International License"), ("CC-BY-SA-4.0",)),
    "cc-by-nc": Licence(("CC BY-NC 4.0", f"{_CC}-NonCommercial 4.0 International License"), ("CC-BY-NC-4.0",)),
    "cc0": Licence(("CC0 1.0", "CC0 1.0 Universal"), ("CC0-1.0",), (_CC0,)),
    "unlicense": Licence(("Unlicense",), ("Unlicense",), (_UNLICENSE,)),
}
# Licences that exist and are of no family above.
OTHERS = (
    Licence(("Artistic License 2.0",), ("Artistic-2.0",)),
    Licence(("Common Development and Distribution License",), ("CDDL-1.0",)),
    Licence(("Python Software Foundation License Version 2",), ("PSF-2.0",)),
    Licence(("SIL Open Font License, Version 1.1",), ("OFL-1.1",)),
    Licence(("European Union Public Licence 1.2",), ("EUPL-1.2",)),
    Licence(("CeCILL Free Software License Agreement",), ("CECILL-2.1",)),
    Licence(("Microsoft Public License",), ("MS-PL",)),
    Licence(("PHP License, version 3.01",), ("PHP-3.01",)),
    Licence(("OpenSSL License",), ("OpenSSL",)),
    Licence(("Academic Free License version 3.0",), ("AFL-3.0",)),
    Licence(("Open Data Commons Open Database License",), ("ODbL-1.0",)),
    Licence(("Server Side Public License",), ("SSPL-1.0",)),
)
# How a licence is named; the last two name it by its identifier.
NAMED = (
    "Licensed under {}.", "Licensed under the {}.", "Released under the {}.", "This project is licensed under the {}.",
    "This work is licensed under the {}.", "Distributed under the terms of the {}.", "{}",
)
IDENTIFIED = ("SPDX-License-Identifier: {}", "License: {}")
# Words around a notice, to vary it.
FRAMES = ("{}", "Copyright 2024 the authors. {}", "{} See the file for details.", "Note: {}", "{} All rights reserved.", "* {}")
# Notices that name no family, made with words of the documents.
NO_NAMES = (
    "Licensed under the {} License.", "Released under the {} licence, version {}.", "This work is licensed under the {} Public License.",
    "All rights reserved by {}; no part may be copied without written permission.", "Use of this software is subject to the {} license terms.",
    "Permission to use and redistribute this software is granted by {} only.", "SPDX-License-Identifier: LicenseRef-{}",
    "You may not copy, modify or distribute this file without a licence from {} {}.",
)
# Sentences of other matters that share words with notices.
ORDINARY = (
    "The committee granted permission to build a bridge over the river.", "You can use the software to copy the table to another file.",
    "The driver's license was issued in the second year.", "A copy of the report is available in the source folder.",
    "See the file for details of each station and its readings.", "The above rules are subject to the conditions of the weather.",
    "Version 2.0 of the program reads the table faster than version 1.", "The general public was not informed of the terms.",
    "This work was done by the authors in the first half of the year.", "The documentation of this function is provided with the source code.",
    "No person shall be held in the building after the hour.", "The software is distributed over many machines and any of them may fail.",
    "x = [1, 2, 3, 4, 5, 6, 7, 8, 9]", "2.0, 1.0, 3.0, 2.1, 4.0, 3.01", "load('1.1', number) == number('1.1')", "1. 2. 3.", "Note", "Changed in version 3.0.",
    "If a copy was not found, the library will read the original file.", "It is free for any person to obtain the data in this form.",
)
