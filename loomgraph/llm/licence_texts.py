"""Published licence texts and notices by licence identifier, and digests of the longer ones.

Titles and copyright lines aren't part of a text; blank lines part its paragraphs.
"""

_AS_IS_MIT = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_AS_IS_ISC = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_SOURCE = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_BINARY = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAME = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_AS_IS_BSD = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_AS_IS_BSD_CLEAR = _AS_IS_BSD.replace("THIS SOFTWARE IS PROVIDED", "NO EXPRESS OR IMPLIED LICENSES TO ANY PARTY'S PATENT RIGHTS ARE GRANTED BY THIS LICENSE. THIS SOFTWARE IS PROVIDED", 1)
_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"""
_MIT_NOTICE = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."


def _numbered(form: str, *clauses: str) -> list[str]:
    """Clauses with their numbers or marks in front, as published."""
    return [form.format(k + 1) + c for k, c in enumerate(clauses)]


#: Short notices, a line each, that name a licence.
NOTICES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-ND-4.0": ["This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "CC-BY-NC-SA-4.0": ["This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."],
    "CC-BY-NC-ND-4.0": ["This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}

#: Texts as paragraphs; a licence may have several published forms.
TEXTS = {
    "MIT": [[_MIT_GRANT + ", subject to the following conditions:", _MIT_NOTICE, _AS_IS_MIT]],
    "MIT-0": [[_MIT_GRANT + ".", _AS_IS_MIT]],
    "X11": [[_MIT_GRANT + ", subject to the following conditions:", _MIT_NOTICE, _AS_IS_MIT.replace("AUTHORS OR COPYRIGHT HOLDERS", "X CONSORTIUM"), "Except as contained in this notice, the name of the X Consortium shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software without prior written authorization from the X Consortium."]],
    "Apache-2.0": [[
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at""",
        "http://www.apache.org/licenses/LICENSE-2.0",
        """Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    ]],
    "GPL-3.0": [[
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ], ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."]],
    "GPL-2.0": [[
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ]],
    "AGPL-3.0": [[
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
        "You should have received a copy of the GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ]],
    "ISC": [
        ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", _AS_IS_ISC],
        ["Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", _AS_IS_ISC],
    ],
    "0BSD": [["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.", _AS_IS_ISC]],
    "BSD-1-Clause": [[_BSD_GRANT, *_numbered("{}. ", _BSD_SOURCE), _AS_IS_BSD]],
    "BSD-2-Clause": [[_BSD_GRANT, *_numbered(form, _BSD_SOURCE, _BSD_BINARY), _AS_IS_BSD] for form in ("{}. ", "* ")],
    "BSD-3-Clause": [[_BSD_GRANT, *_numbered(form, _BSD_SOURCE, _BSD_BINARY, _BSD_NAME), _AS_IS_BSD] for form in ("{}. ", "* ")],
    "BSD-3-Clause-Clear": [[_BSD_GRANT.replace("permitted provided", "permitted (subject to the limitations in the disclaimer below) provided"), *_numbered(form, _BSD_SOURCE, _BSD_BINARY, _BSD_NAME), _AS_IS_BSD_CLEAR] for form in ("{}. ", "* ")],
    "Zlib": [[
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.",
        "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
        "3. This notice may not be removed or altered from any source distribution.",
    ]],
    "BSL-1.0": [[
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:""",
        "The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.",
        """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ]],
    "Unlicense": [[
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
        """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
        "For more information, please refer to <https://unlicense.org/>",
    ]],
    "WTFPL": [["Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION", "0. You just DO WHAT THE FUCK YOU WANT TO."]],
    "PostgreSQL": [[
        "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies.",
        "IN NO EVENT SHALL THE UNIVERSITY OF CALIFORNIA BE LIABLE TO ANY PARTY FOR DIRECT, INDIRECT, SPECIAL, INCIDENTAL, OR CONSEQUENTIAL DAMAGES, INCLUDING LOST PROFITS, ARISING OUT OF THE USE OF THIS SOFTWARE AND ITS DOCUMENTATION, EVEN IF THE UNIVERSITY OF CALIFORNIA HAS BEEN ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
        """THE UNIVERSITY OF CALIFORNIA SPECIFICALLY DISCLAIMS ANY WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE. THE SOFTWARE PROVIDED HEREUNDER IS ON AN "AS IS" BASIS, AND THE UNIVERSITY OF CALIFORNIA HAS NO OBLIGATIONS TO PROVIDE MAINTENANCE, SUPPORT, UPDATES, ENHANCEMENTS, OR MODIFICATIONS.""",
    ]],
    "curl": [[
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT OF THIRD PARTY RIGHTS. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
        "Except as contained in this notice, the name of a copyright holder shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software without prior written authorization of the copyright holder.",
    ]],
    "Fair": [["Usage of the works is permitted provided that this instrument is retained with the works, so that any entity that uses the works is notified of this instrument.", "DISCLAIMER: THE WORKS ARE WITHOUT WARRANTY."]],
    "FSFAP": [["Copying and distribution of this file, with or without modification, are permitted in any medium without royalty provided the copyright notice and this notice are preserved. This file is offered as-is, without any warranty."]],
    "Beerware": [["""wrote this file. As long as you retain this notice you can do whatever you want with this stuff. If we meet some day, and you think this stuff is worth it, you can buy me a beer in return."""]],
}

#: Paragraphs that may stand before a text without being part of it.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "MIT-0": ["MIT No Attribution"],
    "X11": ["X11 License"],
    "ISC": ["ISC License", "The ISC License"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD"],
    "BSD-1-Clause": ["BSD 1-Clause License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License"],
    "BSD-3-Clause-Clear": ["The Clear BSD License"],
    "Zlib": ["zlib License", "The zlib License"],
    "BSL-1.0": ["Boost Software License - Version 1.0 - August 17th, 2003"],
    "Unlicense": ["The Unlicense"],
    "WTFPL": ["DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE Version 2, December 2004"],
    "PostgreSQL": ["PostgreSQL License"],
    "curl": ["COPYRIGHT AND PERMISSION NOTICE"],
    "Fair": ["Fair License"],
}
