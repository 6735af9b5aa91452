"""Licence wordings for the scan. The published texts of the licences, as
words; marks name what may be absent or replaced (see ``license_scan``).

TEXTS are whole licences and NOTICES the whole notices that put a work under a licence: all
of their mandatory wording has to follow. MENTIONS name a licence in a few words. OPENINGS are
the first words of texts; alone they only say that something like the licence begins there.
"""

_ITEM = "<<opt>><<any>>{0}<<or>>{1}<<or>>{2}<</any>><</opt>> "
_FIRST, _SECOND, _THIRD = (_ITEM.format(*x) for x in (("1", "a", "i"), ("2", "b", "ii"), ("3", "c", "iii")))

_MIT_WARRANTY = (
    "the <<any>>software<<or>>work<</any>> is provided as is without warranty of any kind express or implied including but not "
    "limited to the warranties of merchantability fitness for a particular purpose <<any>>and noninfringement<<or>>and "
    "non infringement<<or>>title and noninfringement<<or>>title and non infringement<</any>> in no event shall "
    "{who} be liable for any claim damages or other liability whether in an action of contract tort or "
    "otherwise arising from out of or in connection with the <<any>>software<<or>>work<</any>> or the use or other dealings in the "
    "<<any>>software<<or>>work<</any>>")

_MIT_OPENING = (
    "permission is hereby granted free of charge to any person obtaining a copy of this <<any>>software<<or>>work<</any>> and "
    "associated documentation files <<opt>>the <<any>>software<<or>>work<</any>><</opt>> to deal in the "
    "<<any>>software<<or>>work<</any>> without restriction")

_BSD_OPENING = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
    "conditions are met ")

_BSD_CONDITIONS = (
    _FIRST + "redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer " + _SECOND + "redistributions in binary form must reproduce the above copyright notice this list of conditions and "
    "the following disclaimer in the documentation and or other materials provided with the distribution ")

_BSD_NO_ENDORSEMENT = (
    _THIRD + "neither the <<any>>name<<or>>names<</any>> of <<var:12>> nor the names of <<any>>its<<or>>their<<or>>other<<or>>any"
    "<</any>> contributors may be used to endorse or promote products derived from this software without specific prior written "
    "permission ")

_BSD_WARRANTY = (
    "this software is provided by <<var:12>> as is and any express or implied warranties including but not limited to the implied "
    "warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall <<var:12>> be liable "
    "for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of "
    "substitute goods or services loss of use data or profits or business interruption however caused and on any theory of "
    "liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of "
    "this software even if advised of the possibility of such damage")

TEXTS = {
    "mit": [
        _MIT_OPENING + " including without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
        "copies of the <<any>>software<<or>>work<</any>> and to permit persons to whom the <<any>>software<<or>>work<</any>> is "
        "furnished to do so subject to the following conditions the above copyright notice and this permission notice <<opt>>including "
        "the next paragraph<</opt>> shall be included in all copies or substantial portions of the <<any>>software<<or>>work<</any>> "
        + _MIT_WARRANTY.format(who="<<any>>the authors or copyright holders<<or>>the copyright holders or authors<<or>><<var:12>><</any>>")],
    "isc": [
        "permission to use copy modify and <<opt>>or<</opt>> distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies the software is provided "
        "as is and <<var:12>> <<any>>disclaims<<or>>disclaim<</any>> all warranties with regard to this software including all implied "
        "warranties of merchantability and fitness in no event shall <<var:12>> be liable for any special direct indirect or "
        "consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract "
        "negligence or other tortious action arising out of or in connection with the use or performance of this software"],
    "bsd-2-clause": [_BSD_OPENING + _BSD_CONDITIONS + _BSD_WARRANTY],
    "bsd-3-clause": [_BSD_OPENING + _BSD_CONDITIONS + _BSD_NO_ENDORSEMENT + _BSD_WARRANTY],
    "zlib": [
        "this software is provided as is without any express or implied warranty in no event will the "
        "<<any>>authors<<or>>author<<or>>copyright holders<</any>> be held liable for any damages arising from the use of this software "
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and "
        "redistribute it freely subject to the following restrictions " + _FIRST + "the origin of this software must not be "
        "misrepresented you must not claim that you wrote the original software if you use this software in a product an "
        "<<any>>acknowledgment<<or>>acknowledgement<</any>> in the product documentation would be appreciated but is not required "
        + _SECOND + "altered source versions must be plainly marked as such and must not be misrepresented as being the original "
        "software " + _THIRD + "this notice may not be removed or altered from any source distribution"],
    "unlicense": [
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile "
        "sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non "
        "commercial and by any means in jurisdictions that recognize copyright laws the author or authors of this software dedicate "
        "any and all copyright interest in the software to the public domain we make this dedication for the benefit of the public "
        "at large and to the detriment of our heirs and successors we intend this dedication to be an overt act of relinquishment "
        "in perpetuity of all present and future rights to this software under copyright law "
        + _MIT_WARRANTY.format(who="the authors")],
}

_GNU_NOTICE = (
    "<<any>>program<<or>>library<<or>>software<<or>>file<<or>><<var:6>><</any>> is free software you can redistribute it and or "
    "modify it under the terms of the gnu {name} as published by the free software foundation "
    "<<any>>either version {version} <<opt>>of the license<</opt>> or at your option any later version<<or>>version {version} "
    "<<opt>>only<</opt>> <<opt>>of the license<</opt>><</any>> <<var:6>> is distributed in the hope that it will be useful but without any "
    "warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu {name} for more "
    "details")

_GNU_NAMES = {"gpl-2.0": ("general public license", "2"), "gpl-3.0": ("general public license", "3"),
              "lgpl-2.1": ("<<any>>lesser<<or>>library<</any>> general public license", "2 1"),
              "lgpl-3.0": ("lesser general public license", "3"), "agpl-3.0": ("affero general public license", "3")}

NOTICES = {label: ["this " + _GNU_NOTICE.format(name=name, version=version)] for label, (name, version) in _GNU_NAMES.items()} | {
    "apache-2.0": [
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
        "you may obtain a copy of the license at <<var:9>> unless required by applicable law or agreed to in writing software "
        "distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express "
        "or implied see the license for the specific language governing permissions and limitations under the license"],
    "mpl-2.0": [
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed "
        "with this file you can obtain one at <<any>>http<<or>>https<</any>> <<opt>>www<</opt>> mozilla org mpl 2 0"],
    "epl-2.0": [
        "this program and the accompanying materials are made available under the terms of the eclipse public license <<opt>>v<</opt>> "
        "<<opt>>version<</opt>> 2 0 which <<any>>is available<<or>>accompanies this distribution and is available<</any>> at"],
}

MENTIONS = {
    "apache-2.0": ["licensed under the apache license <<opt>>version<</opt>> 2 0"],
    "gpl-2.0": ["gnu general public license <<any>>version<<or>>v<</any>> 2",
                "gnu general public license as published by the free software foundation <<opt>>either<</opt>> version 2"],
    "gpl-3.0": ["gnu general public license <<any>>version<<or>>v<</any>> 3",
                "gnu general public license as published by the free software foundation <<opt>>either<</opt>> version 3"],
    "lgpl": ["gnu <<any>>lesser<<or>>library<</any>> general public license <<opt>>version <<var:2>><</opt>>"],
    "agpl-3.0": ["gnu affero general public license <<opt>>version 3<</opt>>"],
    "mit": ["released under the mit license", "licensed under the <<opt>>terms of the<</opt>> mit license"],
    "isc": ["licensed under the <<opt>>terms of the<</opt>> isc license", "released under the isc license"],
    "bsd-2-clause": ["2 clause bsd license", "two clause bsd license", "bsd 2 clause license"],
    "bsd-3-clause": ["3 clause bsd license", "three clause bsd license", "bsd 3 clause license"],
    "epl-2.0": ["eclipse public license <<opt>>version<</opt>> <<opt>>v<</opt>> 2 0"],
    "cc-by-4.0": ["cc by 4 0", "creative commons attribution 4 0 <<opt>>international<</opt>>"],
    "cc-by-sa-4.0": ["cc by sa 4 0", "creative commons attribution sharealike 4 0 <<opt>>international<</opt>>"],
    "cc-by-nc-4.0": ["cc by nc 4 0", "creative commons attribution noncommercial 4 0 <<opt>>international<</opt>>"],
    "cc-by-nc-sa-4.0": ["cc by nc sa 4 0"],
    "cc-by-nd-4.0": ["cc by nd 4 0"],
    "cc0-1.0": ["cc0 1 0 <<opt>>universal<</opt>>", "cc0 public domain dedication"],
    "mpl-2.0": ["mozilla public license <<any>>version<<or>>v<</any>> 2 0"],
}

OPENINGS = {"mit": [_MIT_OPENING], "bsd": [_BSD_OPENING],
            "isc": ["permission to use copy modify and <<opt>>or<</opt>> distribute this software for any purpose with or without fee"],
            "zlib": ["permission is granted to anyone to use this software for any purpose including commercial applications"],
            "unlicense": ["this is free and unencumbered software released into the public domain"]}
