"""The data table of known licences (operator 5): full texts, SPDX tags and short notices, as (licence id, text) rows.

Full texts are the files of `license_texts`, named by id; forms in which they differ from file to file (title lines, the
part after "END OF TERMS AND CONDITIONS", addresses, list numbers, wordings of BSD) are rows of their own.
"""

from __future__ import annotations

from itertools import product
from pathlib import Path

FOLDER = Path(__file__).with_name("license_texts")

# Title lines that stand above texts without a title of their own.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT", "MIT/X11 License", "Expat License"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)", "ISC"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "0BSD License", "0BSD"],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License", "zlib"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License',
                     "Simplified BSD License", "FreeBSD License", "BSD License", "The BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License",
                     'BSD 3-Clause "New" or "Revised" License', "New BSD License", "Modified BSD License", "BSD License", "The BSD License"],
    "Unlicense": ["The Unlicense", "Unlicense", "UNLICENSE"],
}

# SPDX ids that a tag may name.
SPDX = """0BSD AFL-3.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-1.0-Perl Artistic-2.0 BlueOak-1.0.0 BSD-1-Clause
BSD-2-Clause BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-3.0 CC-BY-NC-4.0
CC-BY-NC-ND-3.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-3.0 CC-BY-NC-SA-4.0 CC-BY-ND-3.0 CC-BY-ND-4.0 CC-BY-SA-2.0 CC-BY-SA-2.5 CC-BY-SA-3.0 CC-BY-SA-4.0
CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CPL-1.0 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 FTL GFDL-1.2 GFDL-1.2-only GFDL-1.2-or-later GFDL-1.3
GFDL-1.3-only GFDL-1.3-or-later GPL-1.0 GPL-1.0-only GPL-1.0-or-later GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only
GPL-3.0-or-later HPND ICU IJG ISC LGPL-2.0 LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only
LGPL-3.0-or-later Libpng LPPL-1.3c MIT MIT-0 MPL-1.0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0 OFL-1.0 OFL-1.1 OpenSSL OSL-3.0
PDDL-1.0 PHP-3.01 PostgreSQL PSF-2.0 Python-2.0 Ruby SSPL-1.0 TCL Unicode-3.0 Unicode-DFS-2016 Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib
ZPL-2.1""".split()
PAIRS = [("MIT", "Apache-2.0"), ("Apache-2.0", "MIT"), ("MIT", "Unlicense"), ("Unlicense", "MIT"), ("Apache-2.0", "BSD-3-Clause"),
         ("MIT", "GPL-2.0-only"), ("GPL-2.0-only", "MIT"), ("GPL-2.0-only", "BSD-2-Clause"), ("GPL-2.0-only", "BSD-3-Clause"),
         ("GPL-2.0-or-later", "MIT"), ("BSD-3-Clause", "MIT")]

# The names by which short notices call a licence.
NAMES = {
    "MIT": ["MIT License", "MIT"], "ISC": ["ISC License"], "0BSD": ["0BSD License", "Zero-Clause BSD License"], "Zlib": ["zlib License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0 License", "Apache-2.0 License", "Apache 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"], "Unlicense": ["Unlicense"],
    "MPL-1.1": ["Mozilla Public License, version 1.1", "MPL 1.1"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "MPL 2.0", "MPL-2.0 License"],
    "EPL-1.0": ["Eclipse Public License 1.0", "Eclipse Public License v1.0"], "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0"],
    "OFL-1.1": ["SIL Open Font License, Version 1.1", "SIL Open Font License 1.1"], "ODbL-1.0": ["Open Database License 1.0", "Open Database License"],
    "WTFPL": ["WTFPL"], "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal License", "Creative Commons Zero v1.0 Universal", "CC0"],
} | {
    f"{short}-{v}": [f"GNU {name}, version {v.removesuffix('.0')}", f"GNU {name} version {v}", f"GNU {name} v{v}", f"GNU {name} v{v.removesuffix('.0')}",
                     f"GNU {short} v{v.removesuffix('.0')}", f"GNU {short} version {v.removesuffix('.0')}", f"{short} v{v.removesuffix('.0')}", f"{short}-{v}",
                     f"{short}-{v} License", f"{short}v{v.removesuffix('.0')}", f"{short} version {v.removesuffix('.0')}"]
    for short, name, versions in (("GPL", "General Public License", "2.0 3.0"), ("LGPL", "Lesser General Public License", "2.1 3.0"),
                                  ("AGPL", "Affero General Public License", "3.0")) for v in versions.split()
} | {
    f"CC-{kind}-{v}": [f"CC {kind} {v}", f"CC {kind} {v} License", f"Creative Commons {name} {v}", f"Creative Commons {name} {v} License",
                       f"Creative Commons {name} {v} {port}", f"Creative Commons {name} {v} {port} License"]
    for kind, name in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
                       ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                       ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")) for v, port in (("3.0", "Unported"), ("4.0", "International"))
}
SAYS = ["Licensed", "Released", "Distributed", "Available", "Published"] + [
    f"This {what} is {how}" for what in ("work", "project", "software", "program", "library", "code", "file", "document")
    for how in ("licensed", "released", "distributed")]
UNDER = ["under", "under the", "under a", "under the terms of the"]

# Notices of several lines in the heads of files.
GNU_NOTICE = """This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by
the Free Software Foundation, either version {v} of the License, or (at your option) any later version.
This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details.
You should have received a copy of the GNU {name} along with this {thing}. If not, see <https://www.gnu.org/licenses/>."""
MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""

END = "END OF TERMS AND CONDITIONS"
ADDRESSES = [" 59 Temple Place, Suite 330, Boston, MA  02111-1307  USA", " 51 Franklin St, Fifth Floor, Boston, MA  02110-1301  USA",
             " <https://fsf.org/>", " <http://www.fsf.org/>", ""]


def _forms(name: str, text: str) -> list[str]:
    """The text and the other forms in which it is found."""
    forms = [text]
    if name.startswith("BSD-"):
        owners = ["HOLDER OR", "HOLDERS OR", "OWNER OR"]
        names = ["the copyright holder", "the author", "the copyright owner", "the project"]
        forms = [text.replace("HOLDER OR", o).replace("the copyright holder", n) for o, n in product(owners, names)]
        forms += [f.replace("1. ", "").replace("2. ", "").replace("3. ", "") for f in forms]
    if "GPL-" in name and " 51 Franklin" in text:
        lines = text.split("\n")
        at = next(i for i, x in enumerate(lines) if "51 Franklin" in x)
        forms += ["\n".join(lines[:at] + [a] + lines[at + 1:]) for a in ADDRESSES]
    forms += [f[:f.index(END)] + e for f in forms if END in f for e in ("", END)]
    if name == "Unlicense":
        forms.append(text[:text.index("For more information")])
    return forms


def rows() -> list[tuple[str, str]]:
    """(licence id, text): texts, then tags and notices."""
    texts = [(p.stem, form) for p in sorted(FOLDER.glob("*.txt")) for form in _forms(p.stem, p.read_text("utf-8"))]
    texts += [(i, f"{title}\n{text}") for i, text in texts for title in TITLES.get(i, [])]
    texts += [(f"{short}-{v}-or-later", GNU_NOTICE.format(thing=thing, name=name, v=v.removesuffix(".0")))
              for short, name, v in (("GPL", "General Public License", "2.0"), ("GPL", "General Public License", "3.0"),
                                     ("LGPL", "Lesser General Public License", "2.1"), ("LGPL", "Lesser General Public License", "3.0"),
                                     ("AGPL", "Affero General Public License", "3.0")) for thing in ("program", "library", "software", "file")]
    tags = [(i, f"SPDX-License-Identifier: {i}") for i in SPDX]
    tags += [(i, f"SPDX-License-Identifier: {' OR '.join(pair)}") for pair in PAIRS for i in pair]
    notices = [(i, f"{says} {under} {name}.") for i, names in NAMES.items() for name in names for says in SAYS for under in UNDER]
    return list(dict.fromkeys(texts + [("MPL-2.0", MPL_NOTICE)] + tags + notices))
