"""Short licence notices and their word bigrams, for the licence scan (``notices``)."""

from __future__ import annotations

#: fixed values: public licence notices, by SPDX id
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
LEAST = 0.75


def bigrams_of(text: str) -> list[str]:
    """Distinct word bigrams of a template."""
    words = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()
    return list(dict.fromkeys(map(" ".join, zip(words, words[1:]))))
