"""Known licence texts and notices, and equivalent spellings. All are fixed values."""

# Short notices, one line each.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

_MIT_NOTICE = """, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"""

_MIT_BODY = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"""

_ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""

_BSD_NAME = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""

_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""

_GPL3_HEADER = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""

# Titles that a text may have, and whole texts.
_TITLES = {
    "MIT": ["", "MIT", "MIT License", "MIT license:", "The MIT License", "The MIT License (MIT)", "(The MIT License)", "# MIT License", "License (MIT)", "Expat License"],
    "MIT-0": ["", "MIT No Attribution", "MIT-0"],
    "ISC": ["", "ISC", "ISC License", "ISC License (ISC)", "The ISC License"],
    "0BSD": ["", "Zero-Clause BSD", "BSD Zero Clause License", "Zero-Clause BSD License (0BSD)"],
    "BSD-2-Clause": ["", "BSD 2-Clause License", "The BSD 2-Clause License", "BSD License", "The BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["", "BSD 3-Clause License", "The BSD 3-Clause License", "BSD License", "The BSD License", "New BSD License"],
    "Apache-2.0": [""],
    "Zlib": ["", "zlib License", "The zlib License"],
    "GPL-3.0-or-later": [""],
    "WTFPL": ["", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE\nVersion 2, December 2004"],
    "Fair": ["", "Fair License"],
    "FSFAP": [""],
}
_BODIES = [
    ("MIT", _MIT_BODY),
    ("MIT-0", _MIT_BODY.replace(_MIT_NOTICE, "")),
    ("ISC", f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_DISCLAIMER}"),
    ("0BSD", f"{_ISC_GRANT}.\n\n{_ISC_DISCLAIMER}"),
    ("BSD-2-Clause", f"{_BSD_HEAD}\n\n{_BSD_TAIL}"),
    ("BSD-3-Clause", f"{_BSD_HEAD}\n\n{_BSD_NAME}\n\n{_BSD_TAIL}"),
    ("Apache-2.0", _APACHE_HEADER),
    ("Zlib", _ZLIB),
    ("GPL-3.0-or-later", _GPL3_HEADER),
    ("FSFAP", "Copying and distribution of this file, with or without modification, are permitted in any medium without royalty provided the copyright notice and this notice are preserved. This file is offered as-is, without any warranty."),
    ("Fair", "Usage of the works is permitted provided that this instrument is retained with the works, so that any entity that uses the works is notified of this instrument.\n\nDISCLAIMER: THE WORKS ARE WITHOUT WARRANTY."),
    ("WTFPL", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.\n\nDO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE\nTERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION\n\n0. You just DO WHAT THE FUCK YOU WANT TO."),
]
TEXTS = [(name, f"{title}\n\n{body}" if title else body) for name, body in _BODIES for title in _TITLES[name]]

# Digests of the canonical forms of whole texts that are too long to be kept here.
DIGESTS = [
    ("Apache-2.0", "04e64e0427d80fdde16fa8415931bf2c09bc943f13ec322a09df188bf23a3543"),
    ("Apache-2.0", "119e2da0e9ec849d113a40405b338c1bbbd2ef9194c22bf2740fa4e195411c40"),
    ("Apache-2.0", "6df86d8a2cfe223d6d0bacefbfeff6b07e4861587bf8be1a31dcad87a1581967"),
    ("Apache-2.0", "75771523fe42bc2a59b531773aeb5c9ca491991e1dc2a54b7de0e6cd23250749"),
    ("Apache-2.0", "824065d72ca31b7c727341396be4cf76f464b15d9bef680a3638007ce92a009f"),
    ("Apache-2.0", "dc66c5a75f95f568312f2241fd6ea0fa30e4d9bf6366a0ce6b11db07c6b785b3"),
    ("Apache-2.0 WITH LLVM-exception", "9f5b3a5f135cdd8b81512944844d81e083ee1e20109155e2536c6f1fbafbd918"),
    ("Artistic-1.0", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("BlueOak-1.0.0", "9d112ef603d3207d4e033c8a2a46961291832b2ee49b6047ca349781c7898a95"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", "9faf4f9b13ca844eeee37346a77dec74f558096ac2b418782a99c8afe4c772da"),
    ("GPL-3.0", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "cbbde7eeab9b4d180dc00b34252f800e97fb1cddbab38ed8c0c73b956dc2cbf6"),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a"),
    ("PSF-2.0", "40b9af19d3437c4c2f45f06eb67193a4aaca7561d9b16269c66b0b33f8330e2e"),
    ("PSF-2.0", "967d2e5a6fb0ce1c1d4bf18d1f754988ae765021c24c09300c926217df9022d7"),
    ("PSF-2.0", "d57ba8d319837562e25a2c0df49ba3088a4aae734cd16877437c2c7a006eda9d"),
    ("PSF-2.0", "eb2a0f6732d9491a99dc29cd643aa926a93f3f918e9f5b87de3463851f309784"),
    ("Unicode-3.0", "53113a39b79251016cf92b8348f303cee44e4faee1f232536754abc669dd32c8"),
    ("Unlicense", "7a4d92cdb11d254973a073803be1148a5402f1b2ca67808cdb3ef78b596102cd"),
]

# Spellings that count as equal; the first becomes the second.
SPELLINGS = [
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("catalogue", "catalog"),
    ("centre", "center"),
    ("emphasised", "emphasized"),
    ("favour", "favor"),
    ("favourite", "favorite"),
    ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("labour", "labor"),
    ("licence", "license"),
    ("licences", "licenses"),
    ("maximise", "maximize"),
    ("modelled", "modeled"),
    ("modelling", "modeling"),
    ("offence", "offense"),
    ("optimise", "optimize"),
    ("organisation", "organization"),
    ("organise", "organize"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("signalling", "signaling"),
    ("sub license", "sublicense"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("non infringement", "noninfringement"),
    ("per cent", "percent"),
    ("copyright owner", "copyright holder"),
    ("https", "http"),
]
