"""Wordings of public licences.

``NOTICES``: (licence, wording) of notices and whole short licences, which may
be quoted with a few words changed.  ``NAMES``: (licence, wording) of names in a
statement, which must stand word for word.  ``FAMILIES``: (licence, names, versions,
whether later versions may be allowed) of licences that are named with a version;
``licenses.family_pattern`` has the ways to write it.
"""

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution."""

_BSD_3 = _BSD_2 + """ 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission."""

_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""

_GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any
later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
details."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""

_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software
for any purpose, including commercial applications, and to alter it and redistribute it freely"""

_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means."""

NOTICES = [
    ("MIT", _MIT), ("BSD-2-Clause", _BSD_2), ("BSD-3-Clause", _BSD_3), ("Apache-2.0", _APACHE),
    ("GPL-2.0", _GPL.format(2)), ("GPL-3.0", _GPL.format(3)), ("ISC", _ISC), ("MPL-2.0", _MPL), ("Zlib", _ZLIB),
    ("Unlicense", _UNLICENSE),
]

NAMES = [
    ("MIT", "Released under the MIT License"), ("MIT", "under the MIT License"), ("MIT", "MIT License"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"), ("Apache-2.0", "Apache License 2.0"),
    *[(f"GPL-{v}.0", f"licensed under the GNU General Public License, version {v}") for v in (1, 2, 3)],
    *[(f"GPL-{v}.0", f"GNU General Public License v{v}") for v in (1, 2, 3)],
    *[(f"LGPL-{i}", f"GNU Lesser General Public License, version {v}") for i, v in (("2.1", "2.1"), ("3.0", "3"))],
    ("AGPL-3.0", "GNU Affero General Public License, version 3"),
    ("MPL-2.0", "Mozilla Public License 2.0"), ("MPL-2.0", "Mozilla Public License, version 2.0"),
    ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"), ("ISC", "ISC License"),
    *[(f"CC-{kind}-{v}", f"CC {kind} {v}") for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
      for v in ("3.0", "4.0")],
    ("CC0-1.0", "CC0 1.0"),
    *[(f"CC-BY-{v}", f"Creative Commons Attribution {v}") for v in ("3.0", "4.0")],
    *[(f"CC-BY-SA-{v}", f"Creative Commons Attribution-ShareAlike {v}") for v in ("3.0", "4.0")],
    *[(f"CC-BY-NC-{v}", f"Creative Commons Attribution-NonCommercial {v}") for v in ("3.0", "4.0")],
]

NAMES += [
    ("BSD-3-Clause", "3-Clause BSD License"), ("BSD-3-Clause", "New BSD License"), ("BSD-3-Clause", "Modified BSD License"),
    ("BSD-2-Clause", "2-Clause BSD License"), ("BSD-2-Clause", "Simplified BSD License"), ("BSD-2-Clause", "FreeBSD License"),
    ("Zlib", "zlib License"), ("PostgreSQL", "PostgreSQL License"), ("OpenSSL", "OpenSSL License"), ("MS-PL", "Microsoft Public License"),
    ("MS-RL", "Microsoft Reciprocal License"), ("NCSA", "University of Illinois/NCSA Open Source License"),
    ("PSF-2.0", "Python Software Foundation License"), ("Unlicense", "released under the Unlicense"),
    ("WTFPL", "Do What The Fuck You Want To Public License"), ("CC0-1.0", "CC0 1.0 Universal"), ("0BSD", "Zero-Clause BSD License"),
]

FAMILIES = [
    ("GPL", ("GNU General Public License", "GNU GPL", "GPL"), ("1", "2", "3"), True),
    ("LGPL", ("GNU Lesser General Public License", "GNU Library General Public License", "GNU LGPL", "LGPL"), ("2", "2.1", "3"), True),
    ("AGPL", ("GNU Affero General Public License", "Affero General Public License", "GNU AGPL", "AGPL"), ("1", "3"), True),
    ("GFDL", ("GNU Free Documentation License", "GFDL"), ("1.1", "1.2", "1.3"), True),
    ("Apache", ("Apache License", "Apache Software License"), ("1.0", "1.1", "2.0"), False),
    ("MPL", ("Mozilla Public License", "MPL"), ("1.0", "1.1", "2.0"), False),
    ("EPL", ("Eclipse Public License", "EPL"), ("1.0", "2.0"), False),
    ("EUPL", ("European Union Public License", "EUPL"), ("1.0", "1.1", "1.2"), False),
    ("BSL", ("Boost Software License",), ("1.0",), False),
    ("CDDL", ("Common Development and Distribution License", "CDDL"), ("1.0", "1.1"), False),
    ("CPL", ("Common Public License",), ("1.0",), False),
    ("AFL", ("Academic Free License",), ("1.1", "1.2", "2.0", "2.1", "3.0"), False),
    ("OSL", ("Open Software License",), ("1.0", "1.1", "2.0", "2.1", "3.0"), False),
    ("Artistic", ("Artistic License",), ("1.0", "2.0"), False),
    ("OFL", ("SIL Open Font License",), ("1.0", "1.1"), False),
    ("ODbL", ("Open Database License", "ODbL"), ("1.0",), False),
    ("ODC-By", ("Open Data Commons Attribution License",), ("1.0",), False),
    ("PDDL", ("Public Domain Dedication and License",), ("1.0",), False),
    ("LPPL", ("LaTeX Project Public License",), ("1.0", "1.1", "1.2"), False),
    *[(f"CC-{kind}", (f"CC {kind}", f"Creative Commons {spelled}"), ("1.0", "2.0", "2.5", "3.0", "4.0"), False)
      for kind, spelled in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
                            ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))],
]
