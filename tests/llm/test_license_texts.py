"""Whole licenses are labelled, altered or quoted ones are not."""

from trawl.llm import license_templates as lt

MIT = """MIT License. Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do
so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
OPENING = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:
"""
SOURCE = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
BINARY = """2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution. """
HOLDER = "the University of California, Lawrence Berkeley National Laboratory, U.S. Dept. of Energy"
NAMES = f"""3. Neither the name of {HOLDER} nor the names of its contributors may be used to endorse or promote products derived from
this software without specific prior written permission. """
DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS ``AS IS'' AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
THE REGENTS OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING,
BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN
ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""


def labels(text):
    return lt.scan(text)[5]


def test_whole_wording_only():
    assert labels(MIT) == "mit" and labels("before " + MIT * 2 + " after") == "mit"
    assert labels(MIT.replace("THE AUTHORS OR COPYRIGHT HOLDERS", "the " + "Very Long " * 30 + "Consortium")) == "mit"
    evil = MIT.replace("THE SOFTWARE IS PROVIDED", "The Software shall be used for Good, not Evil.\n\nTHE SOFTWARE IS PROVIDED")
    first = MIT[:MIT.index(", including")]
    short = MIT.replace("The above copyright notice and this permission notice", "This notice")
    assert [labels(t) for t in (evil, first, short, MIT[:-40])] == [""] * 4
    assert 0 < lt.scan(evil)[6] < 1
    assert labels(OPENING + SOURCE + BINARY + DISCLAIMER) == "bsd"
    assert labels(OPENING + SOURCE + BINARY + NAMES + DISCLAIMER) == "bsd,bsd-3"
    assert labels(OPENING + "you pay for each copy. " + DISCLAIMER) == "" and labels(OPENING + SOURCE + BINARY) == ""
    assert labels("To the extent possible under law, " + "A B " * 20 + "has waived all copyright and related or neighboring rights to it") == "cc0"


def test_places_and_repeated_openings():
    words = lt.tokens("x y " + MIT)
    (label, start, end), = lt.scan("x y " + MIT)[7][0].values(),
    assert (label, words[start], end) == ("mit", b"permission", len(words))
    twice = [(m["start"], m["end"]) for m in lt.scan(MIT + "some words " + MIT)[7]]
    assert len(twice) == 2 and twice[0][1] <= twice[1][0]
    assert labels("to the extent possible under law " * 5000) == ""
    cut = MIT[:MIT.index("BE LIABLE")]
    assert [m["start"] for m in lt.scan(cut + MIT)[7]] == [len(lt.tokens(cut + MIT[:MIT.index("Permission")]))]


ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL
WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE
LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages
arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications,
and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented;
you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation
would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being
the original software. 3. This notice may not be removed or altered from any source distribution."""


def test_more_licenses_and_spellings():
    assert labels("Copyright 2019 " + ISC) == labels(ISC.replace("and/or distribute", "and distribute")) == "isc"
    assert labels(ZLIB) == labels(ZLIB.replace("acknowledgment", "acknowledgement")) == "zlib"
    for one, other in (("NONINFRINGEMENT", "NON-INFRINGEMENT"), ("sublicense", "sub-license")):
        assert labels(MIT.replace(one, other)) == "mit"
    assert labels(MIT.replace("NONINFRINGEMENT", "NON-INFRINGEMENT").replace("sublicense", "sub-license")) == "mit"
    assert [labels(t) for t in (ISC.replace("with or without fee", "without fee"), ZLIB.replace("anyone", "members"), ISC + ZLIB)] == ["", "", "isc,zlib"]


def test_a_holder_has_at_most_a_hundred_words():
    holder = "THE AUTHORS OR COPYRIGHT HOLDERS"
    assert labels(MIT.replace(holder, "w " * 100)) == "mit"
    assert labels(MIT.replace(holder, "w " * 101)) == labels(MIT.replace(holder, "w " * 60_000)) == ""
