"""Characteristic notices and paragraphs of common licence
families, as the licences or their authors word them, short names under which
they are known, and their SPDX identifiers.

The long texts of the copyleft licences and of the Creative Commons legal codes
are not held paragraph by paragraph: their titles and notices are."""

NOTICES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "The MIT License (MIT)",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Released under the Apache 2.0 license.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2 or later.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0": (
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    ),
    "Unlicense": (
        "Released under the Unlicense.",
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain.",
    ),
    "EPL": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        "Licensed under the Eclipse Public License, version 2.0.",
    ),
}

#: Names of one or two words that stand for a family wherever they occur.
NAMES: dict[str, tuple[str, ...]] = {
    "MIT": ("MIT License", "MIT licensed"),
    "Apache-2.0": ("Apache License", "Apache 2.0", "ALv2"),
    "BSD": ("BSD License", "BSD 3-Clause", "BSD 2-Clause", "3-Clause BSD", "2-Clause BSD", "BSD licensed"),
    "GPL": ("GNU General", "GNU GPL", "GPLv2", "GPLv3", "GPL v2", "GPL v3"),
    "LGPL": ("GNU Lesser", "GNU LGPL", "LGPLv2.1", "LGPLv3", "LGPL v2.1", "LGPL v3"),
    "AGPL": ("GNU Affero", "GNU AGPL", "AGPLv3", "AGPL v3"),
    "MPL-2.0": ("Mozilla Public", "MPL 2.0", "MPLv2"),
    "CC-BY": ("CC BY",),
    "CC-BY-SA": ("CC BY-SA",),
    "CC-BY-NC": ("CC BY-NC", "CC BY-NC-SA", "CC BY-NC-ND"),
    "CC0": ("CC0 1.0", "CC0 Universal"),
    "ISC": ("ISC License",),
    "Unlicense": ("The Unlicense",),
    "EPL": ("Eclipse Public", "EPL 2.0"),
}

#: SPDX identifiers of the families.
SPDX: dict[str, tuple[str, ...]] = {
    "MIT": ("MIT",),
    "Apache-2.0": ("Apache-2.0",),
    "BSD": ("BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause"),
    "GPL": ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"),
    "LGPL": ("LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"),
    "AGPL": ("AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"),
    "MPL-2.0": ("MPL-2.0",),
    "CC-BY": ("CC-BY-3.0", "CC-BY-4.0"),
    "CC-BY-SA": ("CC-BY-SA-3.0", "CC-BY-SA-4.0"),
    "CC-BY-NC": ("CC-BY-NC-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0"),
    "CC0": ("CC0-1.0",),
    "ISC": ("ISC",),
    "Unlicense": ("Unlicense",),
    "EPL": ("EPL-1.0", "EPL-2.0"),
}

#: All templates of a family. An identifier with a number in it stands for
#: the family by itself, the others only behind their tag.
TEMPLATES: dict[str, tuple[str, ...]] = {
    f: (*notices, *NAMES[f], *(f"SPDX-License-Identifier: {x}" for x in SPDX[f]),
        *(x for x in SPDX[f] if any(c.isdigit() for c in x) and " " not in x))
    for f, notices in NOTICES.items()
}
