"""Licence signatures: one line a rule, hand-written, in order of priority.

A line holds ``tier | keyword | label | regex``. A regex is matched against normalised text: lower case, words of
letters, digits and characters beyond ASCII, one space before each. It starts and ends at word ends; ``N`` stands for one word of
digits, ``W`` for any one word, ``W{a,b}`` for several. The keyword is a word that every match holds, so a text without
it needs no matching. Tiers, with the confidence of a find: 1 base phrase, 2 licence text, 3 grant, 4 identifier, 5 link,
6 name, 7 hint. Earlier tiers, and within a tier longer matches, then earlier lines, win over what they contain.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

CONFIDENCE = {1: 1.0, 2: 1.0, 3: 0.95, 4: 0.9, 5: 0.85, 6: 0.7, 7: 0.4}

# The base phrases and their labels.
BASE = """
1 | public | gpl | gnu general public license
1 | apache | apache | apache license
1 | cc | cc-by | cc by
1 | mit | mit | mit license
"""

SIGNATURES = """
2 | merchantability | mit | permission is hereby granted free of charge to any person obtaining a copy W{1,140} merchantability
2 | granted | mit | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
2 | granted | mit-0 | permission is hereby granted free of charge to any person obtaining a copy of this software W{0,60} to permit persons to whom the software is furnished to do so the software is provided as is
2 | granted | boost | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation
2 | granted | isc | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
2 | granted | isc | permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted
2 | granted | 0bsd | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is
2 | granted | hpnd | permission to use copy modify and distribute this software and its documentation for any purpose W{0,6} without fee is hereby granted
2 | granted | x11 | permission is hereby granted free of charge W{1,160} except as contained in this notice the names? of
2 | granted | unicode | permission is hereby granted free of charge to any person obtaining a copy of the unicode data files
2 | granted | curl | permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
2 | granted | postgresql | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
2 | granted | python-2 | licensee a nonexclusive royalty free world wide license to reproduce W{0,20} is hereby granted
2 | granted | ofl | permission is hereby granted free of charge to any person obtaining a copy of the font software
2 | granted | json | permission is hereby granted free of charge W{1,120} the software shall be used for good not evil
2 | evil | json | the software shall be used for good not evil
2 | redistributions | bsd-3-clause | redistributions of source code must retain W{1,80} neither the names? of W{1,12} nor the names of its contributors
2 | redistributions | bsd-4-clause | redistributions of source code must retain W{1,80} all advertising materials mentioning features or use of this software
2 | redistribution | bsd-2-clause | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
2 | redistributions | bsd | redistributions in binary form must reproduce the above copyright notice
2 | redistribution | bsd-3-clause-clear | redistribution and use W{1,120} no express or implied licenses to any party s patent rights
2 | contributors | bsd-3-clause | neither the names? of W{1,12} nor the names of its contributors may be used to endorse or promote
2 | freebsd | bsd-2-clause | the views and conclusions contained in the software W{1,30} freebsd project
2 | altered | zlib | altered source versions must be plainly marked as such and must not be misrepresented
2 | misrepresented | zlib | the origin of this software must not be misrepresented
2 | unencumbered | unlicense | this is free and unencumbered software released into the public domain
2 | unencumbered | unlicense | free and unencumbered software
2 | dedicated | cc0 | the person who associated a work with this deed has dedicated the work to the public domain
2 | waives | cc0 | affirmer hereby overtly fully permanently irrevocably and unconditionally waives
2 | derivative | apache-2.0 | grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce prepare derivative works
2 | perpetual | apache-2.0 | each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable
2 | apache | apache-1.1 | this product includes software developed by the apache software foundation
2 | apache | apache-1.0 | this product includes software developed by the apache group
2 | freedom | gpl | the licenses for most software W{0,6} are designed to take away your freedom to share and change
2 | copyleft | gpl-3.0 | the gnu general public license is a free copyleft license for software and other kinds of works
2 | copyleft | gpl | free copyleft license for software
2 | server | agpl-3.0 | ensure cooperation with the community in the case of network server software
2 | remotely | agpl-3.0 | all users interacting with it remotely through a computer network
2 | packages | lgpl-2.1 | this license the lesser general public license applies to some specially designated software packages
2 | library | lgpl-2.0 | this license the library general public license applies to some specially designated
2 | incorporates | lgpl-3.0 | this version of the gnu lesser general public license incorporates the terms and conditions of version N
2 | invariant | gfdl | with no invariant sections no front cover texts and no back cover texts
2 | invariant | gfdl | with the invariant sections being
2 | mozilla | mpl-2.0 | this source code form is subject to the terms of the mozilla public license v N N
2 | incompatible | mpl-2.0 | this source code form is incompatible with secondary licenses
2 | mozilla | mpl-1.1 | the contents of this file are subject to the mozilla public license version N N
2 | recipient | epl | any use reproduction or distribution of the program constitutes recipient s acceptance of this agreement
2 | eclipse | epl-2.0 | this program and the accompanying materials are made available under the terms of the eclipse public license N N
2 | eclipse | epl-1.0 | the accompanying materials are provided under the terms of this eclipse public license
2 | common | cddl | the contents of this file are subject to the terms of the common development and distribution license
2 | package | artistic | the intent of this document is to state the conditions under which a package may be copied
2 | artistic | artistic-2.0 | everyone is permitted to copy and distribute verbatim copies of this license document W{0,30} artistic
2 | semblance | artistic | the copyright holder maintains some semblance of artistic control
2 | fuck | wtfpl | you just do what the fuck you want to
2 | fuck | wtfpl | do what the fuck you want to public license
2 | beer | beerware | you can buy me a beer in return
2 | beer | beerware | the beer ware license
2 | forgiveness | sqlite | may you do good and not evil may you find forgiveness
2 | blessing | sqlite | in place of a legal notice here is a blessing
2 | warranty | poetic | this work as is we provide no warranty express or implied
2 | openssl | openssl | this product includes software developed by the openssl project
2 | cryptographic | ssleay | this product includes cryptographic software written by eric young
2 | freetype | freetype | portions of this software are copyright W{0,6} the freetype project
2 | independent | ijg | this software is based in part on the work of the independent jpeg group
2 | png | libpng | the png reference library is supplied as is
2 | redistribute | ruby | you can redistribute it and or modify it under either the terms of the
2 | vim | vim | there are no restrictions on distributing unmodified copies of vim
2 | php | php | this product includes php software freely available from
2 | zend | zend | this product includes the zend engine
2 | corrections | intel | this license shall include changes to the software that are error corrections
2 | credit | cc-by | you must give appropriate credit provide a link to the license and indicate if changes were made
2 | commercial | cc-by-nc | you may not use the material for commercial purposes
2 | remix | cc-by-sa | if you remix transform or build upon the material you must distribute your contributions under the same license
2 | remix | cc-by-nd | if you remix transform or build upon the material you may not distribute the modified material
2 | database | odbl | any use of this database W{0,20} open database license
2 | reserved | proprietary | all rights reserved no part of this W{1,8} may be reproduced
2 | reproduced | proprietary | no part of this W{1,6} may be reproduced W{0,12} without W{0,6} permission
2 | confidential | proprietary | confidential and proprietary information
2 | unauthorized | proprietary | unauthorized copying of this file via any medium is strictly prohibited
2 | unauthorized | proprietary | unauthorized W{0,4} reproduction W{0,6} is W{0,2} prohibited
2 | hosted | elastic-2.0 | you may not provide the software to third parties as a hosted or managed service
2 | redistribute | bsl-1.1 | the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use
2 | sell | commons-clause | the license does not grant to you the right to sell the software
2 | restrictions | openrail | use restrictions referenced in W{0,6} apply to the use of the model
2 | improve | llama | you will not use the W{0,6} materials or any output W{0,8} to improve any other large language model
3 | gnu | gpl-3.0 | licensed under the gnu general public license v(?:ersion)? ?3(?: 0)?
3 | gnu | gpl-2.0 | licensed under the gnu general public license v(?:ersion)? ?2(?: 0)?
3 | gnu | gpl-1.0 | licensed under the gnu general public license v(?:ersion)? ?1(?: 0)?
3 | gnu | gpl-3.0-or-later | gnu general public license as published by the free software foundation either version 3 W{0,6} or at your option any later version
3 | gnu | gpl-2.0-or-later | gnu general public license as published by the free software foundation either version 2 W{0,6} or at your option any later version
3 | gnu | gpl-2.0 | gnu general public license version 2 as published by the free software foundation
3 | gnu | gpl-3.0 | gnu general public license version 3 as published by the free software foundation
3 | gnu | gpl-3.0-or-later | gnu general public license W{0,3} version 3 or W{0,2} later
3 | gnu | gpl-2.0-or-later | gnu general public license W{0,3} version 2 or W{0,2} later
3 | gnu | gpl-3.0 | gnu general public license v(?:ersion)? ?3(?: 0)?
3 | gnu | gpl-2.0 | gnu general public license v(?:ersion)? ?2(?: 0)?
3 | gpl | gpl | licensed under W{0,2} gpl
3 | gpl | gpl | released under W{0,2} gpl
3 | gpl | gpl | under the terms of the gpl
3 | lesser | lgpl-3.0-or-later | gnu lesser general public license as published by the free software foundation either version 3 W{0,6} or at your option any later version
3 | lesser | lgpl-2.1-or-later | gnu lesser general public license as published by the free software foundation either version 2 1 W{0,6} or at your option any later version
3 | lesser | lgpl-3.0 | gnu lesser general public license v(?:ersion)? ?3(?: 0)?
3 | lesser | lgpl-2.1 | gnu lesser general public license v(?:ersion)? ?2 1
3 | library | lgpl-2.0 | gnu library general public license v(?:ersion)? ?2(?: 0)?
3 | affero | agpl-3.0-or-later | gnu affero general public license as published by the free software foundation either version 3 W{0,6} or at your option any later version
3 | affero | agpl-3.0 | gnu affero general public license v(?:ersion)? ?3(?: 0)?
3 | apache | apache-2.0 | licensed under the apache license version 2 0
3 | apache | apache-2.0 | licensed under the apache license v?2(?: 0)?
3 | apache | apache-2.0 | licensed under W{0,2} apache 2 0
3 | apache | apache-2.0 | apache license v(?:ersion)? ?2 0
3 | apache | apache-1.1 | apache license v(?:ersion)? ?1 1
3 | apache | apache-2.0 | released under the apache 2(?: 0)?(?: license)?
3 | asf | apache-2.0 | licensed to the apache software foundation asf under one or more contributor license agreements
3 | mit | mit | licensed under the mit license
3 | mit | mit | released under the mit license
3 | mit | mit | distributed under the mit license
3 | mit | mit | available under the mit license
3 | mit | mit | under the terms of the mit license
3 | mit | mit | mit licensed
3 | mit | mit | license mit
3 | mit | mit-or-apache-2.0 | licensed under either W{0,4} apache license W{0,14} or W{0,4} mit license
3 | mit | mit-or-apache-2.0 | dual licensed under W{0,2} mit W{0,2} apache
3 | bsd | bsd-3-clause | licensed under the 3 clause bsd license
3 | bsd | bsd-3-clause | licensed under the bsd 3 clause license
3 | bsd | bsd-3-clause | released under the W{0,2} new bsd license
3 | bsd | bsd-2-clause | licensed under the 2 clause bsd license
3 | bsd | bsd-2-clause | released under the simplified bsd license
3 | bsd | bsd | use of this source code is governed by a bsd style license
3 | bsd | bsd | licensed under W{0,3} bsd
3 | bsd | bsd | released under W{0,3} bsd
3 | mozilla | mpl-2.0 | licensed under the mozilla public license v(?:ersion)? ?2 0
3 | mozilla | mpl-2.0 | mozilla public license v(?:ersion)? ?2 0
3 | mozilla | mpl-1.1 | mozilla public license v(?:ersion)? ?1 1
3 | mpl | mpl-2.0 | the terms of the mpl 2 0
3 | eclipse | epl-2.0 | eclipse public license v(?:ersion)? ?2 0
3 | eclipse | epl-1.0 | eclipse public license v(?:ersion)? ?1 0
3 | european | eupl-1.2 | european union public licen[cs]e v(?:ersion)? ?1 2
3 | european | eupl-1.1 | european union public licen[cs]e v(?:ersion)? ?1 1
3 | boost | boost-1.0 | distributed under the boost software license version 1 0
3 | boost | boost-1.0 | boost software license v(?:ersion)? ?1 0
3 | isc | isc | licensed under the isc license
3 | isc | isc | released under the isc license
3 | zlib | zlib | licensed under the zlib license
3 | zlib | zlib | released under the zlib(?: libpng)? license
3 | sil | ofl-1.1 | this font software is licensed under the sil open font license version 1 1
3 | sil | ofl-1.1 | sil open font license v(?:ersion)? ?1 1
3 | unlicense | unlicense | released under the unlicense
3 | domain | public-domain | released into the public domain
3 | domain | public-domain | placed in the public domain
3 | domain | public-domain | dedicated to the public domain
3 | domain | public-domain | this work is in the public domain
3 | artistic | artistic-2.0 | licensed under the artistic license 2 0
3 | perl | artistic-or-gpl | under the same terms as perl itself
3 | perl | artistic-or-gpl | same terms as the perl N programming language system itself
3 | php | php-3.01 | this source file is subject to version 3 01 of the php license
3 | licensed | cc-by-nc-sa-4.0 | licensed under W{0,4} cc by nc sa 4 0
3 | licensed | cc-by-nc-nd-4.0 | licensed under W{0,4} cc by nc nd 4 0
3 | licensed | cc-by-nc-4.0 | licensed under W{0,4} cc by nc 4 0
3 | licensed | cc-by-sa-4.0 | licensed under W{0,4} cc by sa 4 0
3 | licensed | cc-by-nd-4.0 | licensed under W{0,4} cc by nd 4 0
3 | licensed | cc-by-4.0 | licensed under W{0,4} cc by 4 0
3 | creative | cc-by-nc-sa | creative commons attribution non ?commercial share ?alike
3 | creative | cc-by-nc-nd | creative commons attribution non ?commercial no ?deriv(?:ative)?s
3 | creative | cc-by-nc | creative commons attribution non ?commercial
3 | creative | cc-by-sa | creative commons attribution share ?alike
3 | creative | cc-by-nd | creative commons attribution no ?deriv(?:ative)?s
3 | creative | cc-by-4.0 | creative commons attribution 4 0
3 | creative | cc-by-3.0 | creative commons attribution 3 0
3 | creative | cc-by | creative commons attribution
3 | creative | cc0-1.0 | creative commons zero(?: v?1 0)?(?: universal)?
3 | database | odbl-1.0 | made available under the open database license
3 | community | cdla | community data license agreement
3 | dedication | pddl | public domain dedication and license
3 | government | ogl | contains public sector information licensed under the open government licen[cs]e
3 | llama | llama | llama N W{0,2} community license
3 | responsible | openrail | responsible ai license
3 | reserved | proprietary | proprietary and confidential all rights reserved
3 | terms | terms-of-use | by using this W{1,3} you agree to W{0,3} terms
4 | spdx | apache-2.0 | spdx license identifier apache 2 0
4 | spdx | mit | spdx license identifier mit
4 | spdx | mit-or-apache-2.0 | spdx license identifier mit or apache 2 0
4 | spdx | mit-or-apache-2.0 | spdx license identifier apache 2 0 or mit
4 | spdx | mit-0 | spdx license identifier mit 0
4 | spdx | isc | spdx license identifier isc
4 | spdx | zlib | spdx license identifier zlib
4 | spdx | unlicense | spdx license identifier unlicense
4 | spdx | 0bsd | spdx license identifier 0bsd
4 | spdx | bsd-2-clause | spdx license identifier bsd 2 clause
4 | spdx | bsd-3-clause | spdx license identifier bsd 3 clause
4 | spdx | boost-1.0 | spdx license identifier bsl 1 0
4 | spdx | bsl-1.1 | spdx license identifier busl 1 1
4 | spdx | gpl-1.0 | spdx license identifier gpl 1 0(?: only)?
4 | spdx | gpl-2.0 | spdx license identifier gpl 2 0(?: only)?
4 | spdx | gpl-3.0 | spdx license identifier gpl 3 0(?: only)?
4 | spdx | gpl-2.0-or-later | spdx license identifier gpl 2 0 or later
4 | spdx | gpl-3.0-or-later | spdx license identifier gpl 3 0 or later
4 | spdx | lgpl-2.1 | spdx license identifier lgpl 2 1(?: only)?
4 | spdx | lgpl-3.0 | spdx license identifier lgpl 3 0(?: only)?
4 | spdx | lgpl-2.1-or-later | spdx license identifier lgpl 2 1 or later
4 | spdx | lgpl-3.0-or-later | spdx license identifier lgpl 3 0 or later
4 | spdx | agpl-3.0 | spdx license identifier agpl 3 0(?: only)?
4 | spdx | agpl-3.0-or-later | spdx license identifier agpl 3 0 or later
4 | spdx | mpl-1.1 | spdx license identifier mpl 1 1
4 | spdx | mpl-2.0 | spdx license identifier mpl 2 0
4 | spdx | epl-1.0 | spdx license identifier epl 1 0
4 | spdx | epl-2.0 | spdx license identifier epl 2 0
4 | spdx | eupl-1.2 | spdx license identifier eupl 1 2
4 | spdx | cddl-1.0 | spdx license identifier cddl 1 0
4 | spdx | cc0-1.0 | spdx license identifier cc0 1 0
4 | spdx | cc-by-4.0 | spdx license identifier cc by 4 0
4 | spdx | cc-by-sa-4.0 | spdx license identifier cc by sa 4 0
4 | spdx | cc-by-nc-4.0 | spdx license identifier cc by nc 4 0
4 | spdx | artistic-2.0 | spdx license identifier artistic 2 0
4 | spdx | wtfpl | spdx license identifier wtfpl
4 | spdx | ofl-1.1 | spdx license identifier ofl 1 1
4 | spdx | postgresql | spdx license identifier postgresql
4 | cc | cc-by-nc-sa-4.0 | cc by nc sa 4 0
4 | cc | cc-by-nc-sa-3.0 | cc by nc sa 3 0
4 | cc | cc-by-nc-sa | cc by nc sa
4 | cc | cc-by-nc-nd-4.0 | cc by nc nd 4 0
4 | cc | cc-by-nc-nd-3.0 | cc by nc nd 3 0
4 | cc | cc-by-nc-nd | cc by nc nd
4 | cc | cc-by-nc-4.0 | cc by nc 4 0
4 | cc | cc-by-nc-3.0 | cc by nc 3 0
4 | cc | cc-by-nc | cc by nc
4 | cc | cc-by-sa-4.0 | cc by sa 4 0
4 | cc | cc-by-sa-3.0 | cc by sa 3 0
4 | cc | cc-by-sa | cc by sa
4 | cc | cc-by-nd-4.0 | cc by nd 4 0
4 | cc | cc-by-nd | cc by nd
4 | cc | cc-by-4.0 | cc by 4 0
4 | cc | cc-by-3.0 | cc by 3 0
4 | cc | cc-by-2.0 | cc by 2 0
4 | cc0 | cc0-1.0 | cc0 1 0(?: universal)?
4 | gplv3 | gpl-3.0 | gplv3
4 | gplv2 | gpl-2.0 | gplv2
4 | gpl | gpl-3.0 | gpl v?3(?: 0)?
4 | gpl | gpl-2.0 | gpl v?2(?: 0)?
4 | gpl | gpl-3.0-or-later | gpl v?3(?: 0)? or later
4 | gpl | gpl-2.0-or-later | gpl v?2(?: 0)? or later
4 | lgplv3 | lgpl-3.0 | lgplv3
4 | lgplv2 | lgpl-2.0 | lgplv2(?: 1)?
4 | lgpl | lgpl-3.0 | lgpl v?3(?: 0)?
4 | lgpl | lgpl-2.1 | lgpl v?2 1
4 | agplv3 | agpl-3.0 | agplv3
4 | agpl | agpl-3.0 | agpl v?3(?: 0)?
4 | mpl | mpl-2.0 | mpl v?2 0
4 | epl | epl-2.0 | epl v?2 0
4 | bsd | bsd-3-clause | bsd 3 clause
4 | bsd | bsd-2-clause | bsd 2 clause
4 | bsd | bsd-4-clause | bsd 4 clause
4 | bsd | bsd-3-clause | 3 clause bsd
4 | bsd | bsd-2-clause | 2 clause bsd
5 | opensource | mit | opensource org licenses mit(?: license)?(?: php)?
5 | opensource | apache-2.0 | opensource org licenses apache 2 0
5 | opensource | bsd-3-clause | opensource org licenses bsd 3 clause
5 | opensource | bsd-2-clause | opensource org licenses bsd 2 clause
5 | opensource | bsd | opensource org licenses bsd license(?: php)?
5 | opensource | isc | opensource org licenses isc(?: license)?
5 | opensource | gpl | opensource org licenses gpl license
5 | opensource | artistic-2.0 | opensource org licenses artistic license 2 0
5 | apache | apache-2.0 | apache org licenses license 2 0(?: html| txt)?
5 | apache | apache | apache org licenses
5 | gnu | gpl-3.0 | gnu org licenses gpl 3 0
5 | gnu | gpl-2.0 | gnu org licenses W{0,2} gpl 2 0
5 | gnu | agpl-3.0 | gnu org licenses agpl(?: 3 0)?
5 | gnu | lgpl-3.0 | gnu org licenses lgpl 3 0
5 | gnu | lgpl-2.1 | gnu org licenses W{0,2} lgpl 2 1
5 | gnu | lgpl | gnu org licenses lgpl
5 | gnu | gfdl | gnu org licenses fdl
5 | gnu | gpl | gnu org (?:licenses|copyleft) gpl
5 | gnu | gnu | gnu org licenses
5 | mozilla | mpl-2.0 | mozilla org mpl 2 0
5 | mozilla | mpl | mozilla org mpl
5 | eclipse | epl-2.0 | eclipse org legal epl 2 0
5 | eclipse | epl-1.0 | eclipse org legal epl v10
5 | boost | boost-1.0 | boost org license 1 0
5 | creativecommons | cc-by-nc-sa | creativecommons org licenses by nc sa(?: N N)?
5 | creativecommons | cc-by-nc-nd | creativecommons org licenses by nc nd(?: N N)?
5 | creativecommons | cc-by-nc | creativecommons org licenses by nc(?: N N)?
5 | creativecommons | cc-by-sa | creativecommons org licenses by sa(?: N N)?
5 | creativecommons | cc-by-nd | creativecommons org licenses by nd(?: N N)?
5 | creativecommons | cc-by | creativecommons org licenses by(?: N N)?
5 | creativecommons | cc0-1.0 | creativecommons org publicdomain zero(?: 1 0)?
5 | creativecommons | public-domain | creativecommons org publicdomain mark(?: 1 0)?
5 | unlicense | unlicense | unlicense org
5 | wtfpl | wtfpl | wtfpl net
5 | opendatacommons | odbl | opendatacommons org licenses odbl
5 | opendatacommons | pddl | opendatacommons org licenses pddl
5 | scripts | ofl-1.1 | scripts sil org ofl
5 | choosealicense | license-hint | choosealicense com licenses W
6 | gnu | gpl | gnu gpl
6 | gpl | gpl | gpl licen[cs]ed?
6 | gpl | gpl | general public licen[cs]e gpl
6 | lesser | lgpl | (?:gnu )?lesser general public license
6 | library | lgpl | (?:gnu )?library general public license
6 | lgpl | lgpl | lgpl licen[cs]ed?
6 | affero | agpl | (?:gnu )?affero general public license
6 | agpl | agpl | agpl licen[cs]ed?
6 | documentation | gfdl | gnu free documentation license
6 | apache | apache | apache software license
6 | apache | apache-2.0 | apache 2 0
6 | apache | apache-2.0 | apache 2 license
6 | mit | mit | mit x11 license
6 | mit | mit | expat mit license
6 | expat | mit | expat license
6 | x11 | x11 | x11 license
6 | bsd | bsd | (?:new |modified |simplified |original )?bsd license
6 | bsd | bsd | bsd style license
6 | isc | isc | isc license
6 | zlib | zlib | zlib(?: libpng)? license
6 | mozilla | mpl | mozilla public license
6 | eclipse | epl | eclipse public license
6 | common | cddl | common development and distribution license
6 | common | cpl | common public license
6 | ibm | ipl | ibm public license
6 | microsoft | ms-pl | microsoft public license
6 | microsoft | ms-rl | microsoft reciprocal license
6 | netscape | npl | netscape public license
6 | european | eupl | european union public licen[cs]e
6 | boost | boost | boost software license
6 | artistic | artistic | artistic license
6 | python | python | python software foundation license
6 | psf | python | psf license
6 | ruby | ruby | ruby license
6 | php | php | php license
6 | openssl | openssl | openssl license
6 | postgresql | postgresql | postgresql license
6 | academic | afl | academic free license
6 | educational | ecl | educational community license
6 | open | osl | open software license
6 | font | ofl | (?:sil )?open font license
6 | ofl | ofl | sil ofl
6 | universal | upl | universal permissive license
6 | unlicense | unlicense | the unlicense
6 | wtfpl | wtfpl | wtfpl
6 | cc0 | cc0 | cc0(?: license)?
6 | creative | creative-commons | creative commons licen[cs]e
6 | database | odbl | open database license
6 | data | odc-by | open data commons attribution license
6 | government | ogl | open government licen[cs]e
6 | server | sspl | server side public license
6 | business | bsl-1.1 | business source license
6 | elastic | elastic | elastic license
6 | confluent | confluent | confluent community license
6 | commons | commons-clause | commons clause(?: license)?
6 | polyform | polyform | polyform W{1,2} license
6 | mulan | mulan | mulan (?:permissive software|public) license
6 | openrail | openrail | (?:bigscience |creativeml )?openrail(?: m)?(?: license)?
6 | cecill | cecill | cecill(?: b| c)?(?: license)?
6 | domain | public-domain | public domain
7 | rights | copyright-notice | all rights reserved
7 | copyright | copyright-notice | copyright c (?:19|20)[0-9]{2}
7 | copyright | copyright-notice | copyright (?:19|20)[0-9]{2}
7 | copyrighted | copyright-notice | copyrighted (?:work|material)
7 | license | license-hint | see W{0,2} license file
7 | license | license-hint | see license(?: txt| md)? for (?:details|more information)
7 | license | license-hint | subject to the following license
7 | licence | license-hint | licen[cs]ed under the W{1,4} licence
7 | license | license-hint | licensed under the W{1,4} license
7 | license | license-hint | released under the W{1,4} license
7 | license | license-hint | distributed under the W{1,4} license
7 | licensed | license-hint | (?:is|are) licensed under
7 | redistribute | license-hint | you can redistribute it and or modify it
7 | warranty | license-hint | without warranty of any kind
7 | warranties | license-hint | without warranties or conditions of any kind
7 | royalty | license-hint | royalty free license
7 | copyleft | license-hint | copyleft
7 | copied | license-hint | may be copied freely
"""


@dataclass(frozen=True)
class Rule:
    order: int
    tier: int
    keyword: str
    label: str
    regex: str           # over normalised text; starts with the space before its first word


def compile_rule(pattern: str) -> str:
    """The written form as a regular expression of Java and of Python alike."""
    out = pattern.replace(" W{", "W{")
    out = re.sub(r"W\{(\d+),(\d+)\}", r"(?: [^ ]+){\1,\2}?", out)
    out = re.sub(r"\bW\b", "[^ ]+", out)
    out = re.sub(r"\bN\b", "[0-9]+", out)
    return f" {out}(?= |$)"


def read_rules(text: str) -> list[Rule]:
    lines = [x.split(" | ") for x in text.strip().splitlines()]
    return [Rule(i, int(tier), keyword.strip(), label.strip(), compile_rule(pattern.strip()))
            for i, (tier, keyword, label, pattern) in enumerate(lines)]


RULES = read_rules(BASE + SIGNATURES.lstrip("\n"))
