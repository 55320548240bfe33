"""The license templates of production: public license texts (fixed values).

A template is reported when 80 % of its shingles occur, so it must be a passage
that other licenses hold less of. Passages of 29 words or more allow an edit
inside them; where two licenses differ in a word only, the passage is cut so
that the word's shingles are over a fifth of it. Names are SPDX ids with what
the passage is: ``-header`` (notice of a source file), ``-text`` (of the license
body), ``-name``, ``-link``, or none. A license may have several templates, and a
text that holds another license's passage (BSD-4-Clause that of BSD-3-Clause)
is reported under both.
"""

NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                  "and associated documentation files",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    # the first sentence of all BSD licenses
    "BSD-conditions": "Redistribution and use in source and binary forms, with or without modification, are "
                      "permitted provided that the following conditions are met",
}

_GNU_HEADER = ("without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
               "{0} License for more details. You should have received a copy of the GNU {0} License along with this {1}")
_GNU_VERSION = ("the terms of the GNU {0} License as published by the Free Software Foundation, either version {1} of "
                "the License, or at")

TEXTS = {
    "Apache-2.0-header":
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for "
        "the specific language governing permissions and limitations under the License.",
    "Apache-2.0-text":
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, "
        "worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare "
        "Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such "
        "Derivative Works in Source or Object form.",
    # the second condition followed by the disclaimer at once
    "BSD-2-Clause":
        "the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
        "CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT",
    # the condition on names, from where no holder is named, and the disclaimer
    "BSD-3-Clause":
        "nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "
        "\"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO",
    "BSD-4-Clause":
        "All advertising materials mentioning features or use of this software must display the following "
        "acknowledgement: This product includes software developed by",
    "MIT-text":
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software.",
    "ISC":
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "0BSD":
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE",
    "Unlicense":
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.",
    "Zlib":
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
        "software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject "
        "to the following restrictions",
    "BSL-1.0":
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, "
        "execute, and transmit the Software, and to prepare derivative works of the Software",
    "WTFPL":
        "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing "
        "it is allowed as long as the name is changed.",
    "MPL-2.0-header":
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "MPL-2.0-text":
        "Each Contributor hereby grants You a world-wide, royalty-free, non-exclusive license: under intellectual property "
        "rights (other than patent or trademark) Licensable by such Contributor to use, reproduce, make available, modify, "
        "display, perform, distribute, and otherwise exploit its Contributions",
    "EPL-2.0-header":
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at",
    "EPL-1.0-header":
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "v1.0 which accompanies this distribution, and is available at",
    # the notices of the GNU licenses: any version, and by version
    "GPL-header": _GNU_HEADER.format("General Public", "program"),
    "LGPL-header": _GNU_HEADER.format("Lesser General Public", "library"),
    "AGPL-header": _GNU_HEADER.format("Affero General Public", "program"),
    "GPL-2.0-header": _GNU_VERSION.format("General Public", "2"),
    "GPL-3.0-header": _GNU_VERSION.format("General Public", "3"),
    "LGPL-2.1-header": _GNU_VERSION.format("Lesser General Public", "2.1"),
    "LGPL-3.0-header": _GNU_VERSION.format("Lesser General Public", "3"),
    "AGPL-3.0-header": _GNU_VERSION.format("Affero General Public", "3"),
    "GPL-2.0-text":
        "The licenses for most software are designed to take away your freedom to share and change it. By contrast, the "
        "GNU General Public License is intended to guarantee your freedom to share and change free software--to make sure "
        "the software is free for all its users.",
    "GPL-3.0-text":
        "The GNU General Public License is a free, copyleft license for software and other kinds of works. The licenses "
        "for most software and other practical works are designed to take away your freedom to share and change the works. "
        "By contrast, the GNU General Public License is intended to guarantee your freedom to share and change all "
        "versions of a program",
    "LGPL-2.1-text":
        "This license, the Lesser General Public License, applies to some specially designated software "
        "packages--typically libraries--of the Free Software Foundation and other authors who decide to use it.",
    "LGPL-3.0-text":
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the "
        "GNU General Public License, supplemented by the additional permissions listed below.",
    "AGPL-3.0-text":
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, "
        "specifically designed to ensure cooperation with the community in the case of network server software.",
    "CC0-1.0":
        "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his "
        "or her rights to the work worldwide under copyright law, including all related and neighboring rights, to the "
        "extent allowed by law.",
    "CC0-1.0-text":
        "Affirmer hereby overtly, fully, permanently, irrevocably and unconditionally waives, abandons, and surrenders all "
        "of Affirmer's Copyright and Related Rights and associated claims and causes of action",
    "CC0-1.0-name": "Creative Commons CC0 1.0 Universal",
    "CC0-1.0-link": "creativecommons.org/publicdomain/zero/1.0",
}

_CREATIVE_COMMONS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives",
                     "BY-NC": "Attribution-NonCommercial", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
                     "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
# Up to version 3 the name of ND is NoDerivs.
_PORTS = {"4.0": "International", "3.0": "Unported", "2.5": "Generic", "2.0": "Generic"}


def _creative_commons() -> dict[str, str]:
    out = {}
    for kind, name in _CREATIVE_COMMONS.items():
        for version, port in _PORTS.items():
            full = (name if version == "4.0" else name.replace("NoDerivatives", "NoDerivs"))
            out[f"CC-{kind}-{version}-name"] = f"Creative Commons {full} {version} {port}"
            out[f"CC-{kind}-{version}-link"] = f"creativecommons.org/licenses/{kind.lower()}/{version}"
        out[f"CC-{kind}-4.0-text"] = (f"bound by the terms and conditions of this Creative Commons {name} 4.0 International "
                                      "Public License")
    return out


TEMPLATES = {**NOTICES, **TEXTS, **_creative_commons()}
