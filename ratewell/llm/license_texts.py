"""Public license wordings in template markup.

``<<beginOptional>> .. <<endOptional>>`` holds wording that may be missing. ``<<var;name;words=a-b>>``
stands for any ``a`` to ``b`` words, ``<<var;name;match=x|y z>>`` for one of the given wordings.
Everything else is mandatory, word by word. Add templates here, or pass others to ``scan_licenses``.
"""

from __future__ import annotations

#: Phrases that count by themselves.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

_WARRANTY = """
    THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
    THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
    <<var;holders;words=1-12>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT
    OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""

_BSD = """
    Redistribution and use <<beginOptional>>of this software<<endOptional>> in source and binary forms, with or without
    modification, are permitted provided that the following conditions are met: <<var;bullet;words=0-1>>
    Redistributions of source code must retain the above copyright notice, this list of conditions and the following
    disclaimer. <<var;bullet;words=0-1>> Redistributions in binary form must reproduce the above copyright notice, this list
    of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""

_BSD_END = """
    THIS SOFTWARE IS PROVIDED BY <<var;holders;words=1-16>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
    LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
"""

#: Whole license texts, headers and statements by label.
TEMPLATES = (
    (
        "mit",
        """
        Permission is hereby granted, free of charge, to any person obtaining a copy of <<var;material;words=1-10>>
        (the "<<var;short;words=1-3>>"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
        permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright
        notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included
        in all copies or substantial portions of the Software."""
        + _WARRANTY,
    ),
    (
        "isc",
        """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.
        <<beginOptional>>THE SOFTWARE IS PROVIDED "AS IS" AND <<var;holders;words=1-12>> DISCLAIMS ALL WARRANTIES WITH REGARD
        TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.<<endOptional>>""",
    ),
    ("bsd-2-clause", _BSD + _BSD_END),
    (
        "bsd-3-clause",
        _BSD
        + """
        <<var;bullet;words=0-1>> Neither the name of <<var;holder;words=1-12>> nor the names of its contributors may be used to
        endorse or promote products derived from this software without specific prior written permission."""
        + _BSD_END,
    ),
    (
        "zlib",
        """
        Permission is granted to anyone to use this software for any purpose, including commercial applications, and to
        alter it and redistribute it freely, subject to the following restrictions""",
    ),
    (
        "apache-2",
        """
        Licensed under <<beginOptional>>the terms of<<endOptional>> the Apache License, Version 2.0
        <<beginOptional>>(the "License"); you may not use this file except in compliance with the License.<<endOptional>>""",
    ),
    (
        "gpl-2",
        """
        <<var;verb;match=licensed|released|distributed>> under <<beginOptional>>the terms of<<endOptional>> the GNU General Public
        License <<beginOptional>>as published by the Free Software Foundation<<endOptional>> <<beginOptional>>GPL<<endOptional>>
        <<var;version;match=version 2|v2>>""",
    ),
    (
        "gpl-3",
        """
        <<var;verb;match=licensed|released|distributed>> under <<beginOptional>>the terms of<<endOptional>> the GNU General Public
        License <<beginOptional>>as published by the Free Software Foundation<<endOptional>> <<beginOptional>>GPL<<endOptional>>
        <<var;version;match=version 3|v3>>""",
    ),
    (
        "gpl-or-later",
        """
        redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free
        Software Foundation; either version <<var;version;match=2|3>> of the License, or (at your option) any later version""",
    ),
    (
        "mpl-2",
        """
        Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0""",
    ),
    (
        "mit",
        """
        <<var;verb;match=licensed|released|distributed|available>> under <<beginOptional>>the terms of<<endOptional>>
        <<var;article;match=the|an>> MIT <<beginOptional>>open source<<endOptional>> License""",
    ),
    (
        "cc-by-nc",
        """
        <<var;verb;match=licensed|released|distributed|available>> under <<beginOptional>>a<<endOptional>>
        <<var;name;match=cc by nc|creative commons attribution noncommercial|creative commons attribution non commercial>>
        <<var;version;words=0-2>> <<beginOptional>>international license<<endOptional>>""",
    ),
    (
        "cc-by",
        """
        <<var;verb;match=licensed|released|distributed|available>> under <<beginOptional>>a<<endOptional>>
        <<var;name;match=cc by|creative commons attribution>> <<var;version;match=3 0|4 0>>""",
    ),
    (
        "unlicense",
        """
        free and unencumbered software released into the public domain""",
    ),
)
