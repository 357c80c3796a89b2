"""Texts of short public licences and common notices, digests of long ones: fixed values."""

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so"""

_MIT_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

MIT = f"""MIT License

{_MIT_GRANT}, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

{_MIT_WARRANTY}
"""

MIT_0 = f"""MIT No Attribution

{_MIT_GRANT}.

{_MIT_WARRANTY}
"""

ISC = """ISC License

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
"""

ZERO_BSD = ISC.replace("ISC License", "BSD Zero Clause License").replace(", provided that the above\ncopyright notice and this permission notice appear in all copies.", ".")

_BSD_TOP = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""

_BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""

BSD_2 = "BSD 2-Clause License\n\n" + _BSD_TOP + _BSD_END

BSD_3 = (
    "BSD 3-Clause License\n\n"
    + _BSD_TOP
    + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
    + _BSD_END
)

ZLIB = """zlib License

This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software. If you use this software
   in a product, an acknowledgment in the product documentation would be
   appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
   misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.
"""

APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""

UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.

In jurisdictions that recognize copyright laws, the author or authors
of this software dedicate any and all copyright interest in the
software to the public domain. We make this dedication for the benefit
of the public at large and to the detriment of our heirs and
successors. We intend this dedication to be an overt act of
relinquishment in perpetuity of all present and future rights to this
software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR
OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
OTHER DEALINGS IN THE SOFTWARE.
"""

UNLICENSE_LINK = """
For more information, please refer to <https://unlicense.org/>
"""

BSL_1 = """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization
obtaining a copy of the software and accompanying documentation covered by
this license (the "Software") to use, reproduce, display, distribute,
execute, and transmit the Software, and to prepare derivative works of the
Software, and to permit third-parties to whom the Software is furnished to
do so, all subject to the following:

The copyright notices in the Software and this entire statement, including
the above license grant, this restriction and the following disclaimer,
must be included in all copies of the Software, in whole or in part, and
all derivative works of the Software, unless such copies or derivative
works are solely in the form of machine-executable object code generated by
a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT
SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE
FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE.
"""



def _untitled(text: str) -> str:
    return text.partition("\n\n")[2]


#: Ids are SPDX identifiers; "-notice" marks a notice that stands for a licence. Licences with a title are known without it, too.
LICENSES = (
    ("0BSD", ZERO_BSD),
    ("Apache-2.0-notice", APACHE_NOTICE),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", BSD_2),
    ("BSD-3-Clause", BSD_3),
    ("BSL-1.0", BSL_1),
    ("BSL-1.0", _untitled(BSL_1)),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", ISC),
    ("ISC", _untitled(ISC)),
    ("MIT", MIT),
    ("MIT", _untitled(MIT)),
    ("MIT-0", MIT_0),
    ("MIT-0", _untitled(MIT_0)),
    ("MIT-notice", "Released under the MIT License."),
    ("Unlicense", UNLICENSE + UNLICENSE_LINK),
    ("Unlicense", UNLICENSE),
    ("Zlib", ZLIB),
    ("Zlib", _untitled(ZLIB)),
)

#: Digests of the canonical forms (``licenses.digest``) of longer texts, as Debian's /usr/share/common-licenses has
#: them; where an appendix follows the words "END OF TERMS AND CONDITIONS", also of the text up to there.
DIGESTS = (
    ("Apache-2.0", "dbb777d3ad1fb948fbe99e6748cbd3fea3f269381f3f7efe3f4259a28a9269c9"),
    ("Apache-2.0", "37aa90548985ac0057637d42c3153e8b5d107a21d9556d7fbe60e3e426fdacaa"),
    ("Artistic-1.0-Perl", "bc4d0c00d493021b9f3b1041689fa28b4bf980cf2e37601f7cb475a7265e3b93"),
    ("BSD-3-Clause", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "3178a7b2a9e4008f52f1a3992385b6071e9df05bdb9cd45b47673da8b411c518"),
    ("GFDL-1.3", "33d036ee806929f616407b9542edbc6fd32856e5d66bbd054fd5cc76e6b4702a"),
    ("GPL-1.0", "ccd3f1b2ddde596f7248e07e9e460ec0517ea5d0194a597bdba1d7da8ed1c2ba"),
    ("GPL-1.0", "38e3a35959fa4735cd867e5fe8e8f5d183f5a19d771360189b83e89391ef7950"),
    ("GPL-2.0", "4488ffb4b6add39cb373aba964cc400f5ac17d920039ece76f11400c5b01e5e5"),
    ("GPL-2.0", "6186c2b9e1fbbfe994a454357b050eab51d49760436171460ff3d09dc6877fd1"),
    ("GPL-3.0", "b2ae9f121ef62e3220ce27db9bae7d01667c856ac27fc2bd53ac55f0d22aa1e5"),
    ("GPL-3.0", "4a9083dfa89bea4f460e373a4c7a4645205d5e3d3be775d544b10357e357f57b"),
    ("LGPL-2.0", "07ea55842178b65d9e7ee1bbf398dda46d3f1ae7036217e299c0d5ef1eab3649"),
    ("LGPL-2.0", "5ca4718fa3c5d8f13b6eba5034273a44e7fef83cc37e1b5ef87856eb562f184e"),
    ("LGPL-2.1", "2edbc90847a6ddf5651b29a800076db76eb12973e92d3076c52492d9a9b06772"),
    ("LGPL-2.1", "51d50a2196491ba81648d8d09aa62ccd2d644f63f7d0f0ce90d473c641fb2010"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "d610395f65da394137e7346ecc99abcfa57d69324e5dafe4ad3ba7f3d7934056"),
    ("MPL-2.0", "2ae5d4417f09cff2e3412d0e35c4ee2439f6c18ca69d7d9cc799b33614c368a5"),
)
