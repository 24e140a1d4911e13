"""Signatures of licenses, in the order of precedence: priority, keyword, label, regular expression.

Expressions match lower-case words separated by single spaces, from a word's start to a word's end.
The keyword is a word that any match must hold.  Priority 1: complete notices and identifiers that
name one license; 2: names with a version; 3: names without a version, links; 4: hints.
"""

BASE = """
1 license mit mit license
1 license apache apache license
1 license gpl general public license
"""

# spdx identifiers share one form each: "spdx license identifier <words of the identifier>"
IDENTIFIERS = """
0bsd; aal; afl-1.1; afl-1.2; afl-2.0; afl-2.1; afl-3.0; agpl-1.0; agpl-3.0; apache-1.0; apache-1.1; apache-2.0; apsl-1.0; apsl-1.1; apsl-1.2; apsl-2.0
artistic-1.0; artistic-2.0; beerware; blueoak-1.0.0; bsd-1-clause; bsd-2-clause; bsd-2-clause-patent; bsd-3-clause; bsd-3-clause-clear; bsd-4-clause; bsd-protection
bsl-1.0; busl-1.1; bzip2-1.0.6; cc0-1.0; cc-by-1.0; cc-by-2.0; cc-by-2.5; cc-by-3.0; cc-by-4.0; cc-by-nc-3.0; cc-by-nc-4.0; cc-by-nc-nd-3.0; cc-by-nc-nd-4.0; cc-by-nc-sa-3.0; cc-by-nc-sa-4.0
cc-by-nd-3.0; cc-by-nd-4.0; cc-by-sa-2.0; cc-by-sa-2.5; cc-by-sa-3.0; cc-by-sa-4.0; cddl-1.0; cddl-1.1; cecill-1.0; cecill-2.0; cecill-2.1; cecill-b; cecill-c; cpal-1.0; cpl-1.0
curl; ecl-1.0; ecl-2.0; efl-1.0; efl-2.0; elastic-2.0; epl-1.0; epl-2.0; eudatagrid; eupl-1.0; eupl-1.1; eupl-1.2; fair; ftl; gfdl-1.1; gfdl-1.2; gfdl-1.3
gpl-1.0; gpl-2.0; gpl-3.0; hpnd; icu; ijg; imagemagick; intel; ipa; ipl-1.0; isc; jpnic; json; lgpl-2.0; lgpl-2.1; lgpl-3.0; libpng; libpng-2.0; libtiff; lppl-1.0; lppl-1.1; lppl-1.2; lppl-1.3c
miros; mit; mit-0; mit-cmu; motosoto; mpl-1.0; mpl-1.1; mpl-2.0; ms-pl; ms-rl; mulanpsl-1.0; mulanpsl-2.0; multics; nasa-1.3; naumen; ncsa; ngpl; nokia; nosl; npl-1.0; npl-1.1; nposl-3.0; ntp
oclc-2.0; odbl-1.0; odc-by-1.0; ofl-1.0; ofl-1.1; ogl-uk-3.0; oldap-2.8; openssl; osl-1.0; osl-2.0; osl-2.1; osl-3.0; parity-7.0.0; pddl-1.0; php-3.0; php-3.01; polyform-noncommercial-1.0.0; postgresql
psf-2.0; python-2.0; qpl-1.0; ruby; sgi-b-2.0; simpl-2.0; sissl; sleepycat; spl-1.0; sspl-1.0; tcl; ucl-1.0; unicode-dfs-2016; unlicense; upl-1.0; vim; vsl-1.0; w3c; watcom-1.0; wtfpl; x11; xnet; zend-2.0; zlib; zpl-2.0; zpl-2.1
"""

SIGNATURES = r"""
1 permission mit permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
1 noninfringement mit the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement
1 permission isc permission to use copy modify and( or)? distribute this software for any purpose with or without fee is hereby granted provided that
1 permission 0bsd permission to use copy modify and( or)? distribute this software for any purpose with or without fee is hereby granted(?! provided)
1 permission hpnd permission to use copy modify distribute and sell this software and its documentation for any purpose is hereby granted without fee
1 apache apache-2.0 licensed under the apache license version 2 0
1 apache apache-2.0 apache license version 2 0 january 2004
1 apache apache-1.1 the apache software license version 1 1
1 redistribution bsd redistribution and use in source and binary forms with or without modification are permitted
1 endorse bsd-3-clause neither the name of( \S+){1,12} nor the names of its contributors may be used to endorse or promote products
1 advertising bsd-4-clause all advertising materials mentioning features or use of this software must display
1 free gpl this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
1 free gpl-2.0 under the terms of the gnu general public license as published by the free software foundation either version 2
1 free gpl-3.0 under the terms of the gnu general public license as published by the free software foundation either version 3
1 lesser lgpl-2.1 under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1
1 lesser lgpl-3.0 under the terms of the gnu lesser general public license as published by the free software foundation either version 3
1 library lgpl-2.0 under the terms of the gnu library general public license as published by the free software foundation either version 2
1 affero agpl-3.0 under the terms of the gnu affero general public license as published by the free software foundation either version 3
1 mozilla mpl-2.0 this source code form is subject to the terms of the mozilla public license v 2 0
1 mozilla mpl-1.1 the contents of this file are subject to the mozilla public license version 1 1
1 eclipse epl-2.0 this program and the accompanying materials are made available under the terms of the eclipse public license 2 0
1 eclipse epl-1.0 this program and the accompanying materials are made available under the terms of the eclipse public license v1 0
1 unencumbered unlicense this is free and unencumbered software released into the public domain
1 altered zlib altered source versions must be plainly marked as such and must not be misrepresented as being the original software
1 boost bsl-1.0 boost software license version 1 0 august 17th 2003
1 cddl cddl-1.0 common development and distribution license cddl version 1 0
1 cddl cddl-1.1 common development and distribution license cddl version 1 1
1 fuck wtfpl do what the fuck you want to public license
1 beer beerware the beer ware license revision 42
1 dedicated cc0-1.0 (the person who associated a work with this deed has|has) dedicated the work to the public domain
1 font ofl-1.1 this font software is licensed under the sil open font license version 1 1
1 evil json the software shall be used for good not evil
1 hosted elastic-2.0 you may not provide the software to third parties as a hosted or managed service
1 redistributions sleepycat redistributions in any form must be accompanied by information on how to obtain complete source code
1 openssl openssl this product includes software developed by the openssl project
1 php php-3.01 this product includes php software freely available from
1 python psf-2.0 python software foundation license version 2
1 postgresql postgresql postgresql database management system formerly known as postgres
1 artistic artistic-2.0 the artistic license 2 0
1 eupl eupl-1.2 licensed under the eupl version 1 2 or( as soon they will be approved by the)? later
1 business busl-1.1 business source license 1 1
1 server sspl-1.0 server side public license version 1
1 rights all-rights-reserved copyright( \S+){1,12} all rights reserved
2 gnu gpl-1.0 gnu general public license( version| v)? 1
2 gnu gpl-2.0 gnu general public license( version| v)? ?2( 0)?
2 gnu gpl-3.0 gnu general public license( version| v)? ?3( 0)?
2 gpl gpl-1.0 (gnu )?gpl ?v? ?1( 0)?
2 gpl gpl-2.0 (gnu )?gpl (version |v ?)?2( 0)?
2 gplv2 gpl-2.0 (gnu )?gplv2( 0)?
2 gpl gpl-3.0 (gnu )?gpl (version |v ?)?3( 0)?
2 gplv3 gpl-3.0 (gnu )?gplv3( 0)?
2 lgpl lgpl-2.0 (gnu )?lgpl (version |v ?)?2 0
2 lgpl lgpl-2.1 (gnu )?lgpl (version |v ?)?2 1
2 lgplv2 lgpl-2.1 (gnu )?lgplv2 1
2 lgpl lgpl-3.0 (gnu )?lgpl (version |v ?)?3( 0)?
2 lgplv3 lgpl-3.0 (gnu )?lgplv3( 0)?
2 lesser lgpl-2.1 gnu lesser general public license( version| v)? ?2 1
2 lesser lgpl-3.0 gnu lesser general public license( version| v)? ?3( 0)?
2 agpl agpl-3.0 (gnu )?agpl (version |v ?)?3( 0)?
2 agplv3 agpl-3.0 (gnu )?agplv3
2 affero agpl-1.0 affero general public license( version| v)? ?1
2 affero agpl-3.0 gnu affero general public license( version| v)? ?3( 0)?
2 apache apache-1.0 apache (software )?license( version| v)? ?1 0
2 apache apache-1.1 apache (software )?license( version| v)? ?1 1
2 apache apache-2.0 apache (software )?license( version| v)? ?2( 0)?
2 apache apache-2.0 apache 2( 0)?( license)?
2 asl apache-2.0 asl 2( 0)?
2 mozilla mpl-1.0 mozilla public license( version| v)? ?1 0
2 mozilla mpl-1.1 mozilla public license( version| v)? ?1 1
2 mozilla mpl-2.0 mozilla public license( version| v)? ?2( 0)?
2 mpl mpl-2.0 mpl 2( 0)?
2 mpl mpl-1.1 mpl 1 1
2 eclipse epl-1.0 eclipse public license( version| v)? ?1( 0)?
2 eclipse epl-2.0 eclipse public license( version| v)? ?2( 0)?
2 epl epl-1.0 epl 1 0
2 epl epl-2.0 epl 2 0
2 distribution cddl-1.0 common development and distribution license( version| v)? ?1 0
2 distribution cddl-1.1 common development and distribution license( version| v)? ?1 1
2 clause bsd-2-clause (bsd )?(2|two) clause( bsd)? license
2 clause bsd-3-clause (bsd )?(3|three) clause( bsd)? license
2 clause bsd-4-clause (bsd )?(4|four) clause( bsd)? license
2 simplified bsd-2-clause simplified bsd license
2 freebsd bsd-2-clause freebsd license
2 bsd bsd-3-clause (revised|new) bsd license
2 modified bsd-3-clause modified bsd license
2 original bsd-4-clause original bsd license
2 clear bsd-3-clause-clear clear bsd license
2 attribution cc-by-1.0 (creative commons )?attribution( license)? 1 0( generic)?
2 attribution cc-by-2.0 (creative commons )?attribution( license)? 2 0( generic)?
2 attribution cc-by-2.5 (creative commons )?attribution( license)? 2 5( generic)?
2 attribution cc-by-3.0 (creative commons )?attribution( license)? 3 0( unported)?
2 attribution cc-by-4.0 (creative commons )?attribution( license)? 4 0( international)?
2 attribution cc-by-sa-2.0 (creative commons )?attribution share ?alike 2 0
2 sharealike cc-by-sa-2.5 (creative commons )?attribution sharealike 2 5
2 sharealike cc-by-sa-3.0 (creative commons )?attribution sharealike 3 0
2 sharealike cc-by-sa-4.0 (creative commons )?attribution sharealike 4 0
2 noncommercial cc-by-nc-3.0 (creative commons )?attribution noncommercial 3 0
2 noncommercial cc-by-nc-4.0 (creative commons )?attribution noncommercial 4 0
2 noncommercial cc-by-nc-sa-3.0 (creative commons )?attribution noncommercial sharealike 3 0
2 noncommercial cc-by-nc-sa-4.0 (creative commons )?attribution noncommercial sharealike 4 0
2 noncommercial cc-by-nc-nd-3.0 (creative commons )?attribution noncommercial noderivs 3 0
2 noncommercial cc-by-nc-nd-4.0 (creative commons )?attribution noncommercial noderivatives 4 0
2 noderivs cc-by-nd-3.0 (creative commons )?attribution noderivs 3 0
2 noderivatives cc-by-nd-4.0 (creative commons )?attribution noderivatives 4 0
2 cc cc-by-4.0 cc by 4 0
2 cc cc-by-3.0 cc by 3 0
2 cc cc-by-sa-4.0 cc by sa 4 0
2 cc cc-by-sa-3.0 cc by sa 3 0
2 cc cc-by-nc-4.0 cc by nc 4 0
2 cc cc-by-nd-4.0 cc by nd 4 0
2 cc cc-by-nc-sa-4.0 cc by nc sa 4 0
2 cc cc-by-nc-nd-4.0 cc by nc nd 4 0
2 cc0 cc0-1.0 (creative commons )?cc0( 1 0)?( universal)?
2 boost bsl-1.0 boost software license( version)?( 1 0)?
2 artistic artistic-1.0 artistic license( version)? 1 0
2 artistic artistic-2.0 artistic license( version)? 2 0
2 font ofl-1.0 (sil )?open font license( version)? 1 0
2 font ofl-1.1 (sil )?open font license( version)? 1 1
2 documentation gfdl-1.1 gnu free documentation license version 1 1
2 documentation gfdl-1.2 gnu free documentation license version 1 2
2 documentation gfdl-1.3 gnu free documentation license version 1 3
2 academic afl-2.1 academic free license( version)? 2 1
2 academic afl-3.0 academic free license( version)? 3 0
2 osl osl-3.0 osl 3 0
2 software osl-3.0 open software license( version)? 3 0
2 database odbl-1.0 open (data commons open )?database license( v)?( 1 0)?
2 dedication pddl-1.0 public domain dedication and licen[cs]e
2 reciprocal ms-rl microsoft reciprocal license
2 microsoft ms-pl microsoft public license
2 european eupl-1.1 european union public licen[cs]e( version| v)? ?1 1
2 european eupl-1.2 european union public licen[cs]e( version| v)? ?1 2
2 cecill cecill-2.1 cecill( free software license agreement)?( version)? 2 1
2 cecill cecill-b cecill b
2 cecill cecill-c cecill c
2 zope zpl-2.1 zope public license( version)? 2 1
2 zope zpl-2.0 zope public license( version)? 2 0
2 netscape npl-1.1 netscape public license( version)? 1 1
2 lppl lppl-1.3c lppl( version)? 1 3c
2 latex lppl-1.3c latex project public license( version)? 1 3c
2 latex lppl-1.2 latex project public license( version)? 1 2
2 public qpl-1.0 q(t)? public license( version)? 1 0
2 sun sissl sun industry standards source license
2 common cpl-1.0 common public license( version)? 1 0
2 common cpal-1.0 common public attribution license( version)? 1 0
2 ibm ipl-1.0 ibm public license( version)? 1 0
2 apple apsl-2.0 apple public source license( version)? 2 0
2 educational ecl-2.0 educational community license( version)? 2 0
2 polyform polyform-noncommercial-1.0.0 polyform noncommercial license 1 0 0
2 mulan mulanpsl-2.0 mulan (permissive software license|psl)( v)?2
2 universal upl-1.0 universal permissive license( v)? 1 0
2 zend zend-2.0 zend (engine )?license( version)? 2 0
2 python python-2.0 python (license )?2 0( license)?
2 openldap oldap-2.8 openldap public license( version)? 2 8
2 nasa nasa-1.3 nasa open source agreement( version)? 1 3
2 oclc oclc-2.0 oclc research public license 2 0
2 blue blueoak-1.0.0 blue oak model license 1 0 0
2 parity parity-7.0.0 parity public license 7 0 0
3 gnu gpl gnu general public licen[cs]e
3 gnu gpl gnu gpl
3 gpl gpl licensed under (the )?gpl
3 lesser lgpl (gnu )?lesser general public licen[cs]e
3 library lgpl (gnu )?library general public license
3 lgpl lgpl (gnu|the) lgpl( license)?
3 affero agpl (gnu )?affero general public licen[cs]e
3 agpl agpl (gnu|the) agpl( license)?
3 documentation gfdl gnu free documentation license
3 apache apache (the )?apache (software )?licen[cs]e
3 apache apache-2.0 www apache org licenses license 2 0( txt| html)?
3 licenses mit opensource org licenses mit( license)?( php)?
3 licenses isc opensource org licenses isc
3 licenses bsd opensource org licenses bsd( license)?
3 licenses bsd-2-clause opensource org licenses bsd 2 clause
3 licenses bsd-3-clause opensource org licenses bsd 3 clause
3 licenses apache-2.0 opensource org licenses apache 2 0
3 licenses gpl-2.0 gnu org licenses (old licenses )?gpl 2 0( \S+)?
3 licenses gpl-3.0 gnu org licenses gpl 3 0( \S+)?
3 licenses lgpl-2.1 gnu org licenses (old licenses )?lgpl 2 1( \S+)?
3 licenses lgpl-3.0 gnu org licenses lgpl 3 0( \S+)?
3 licenses agpl-3.0 gnu org licenses agpl 3 0( \S+)?
3 licenses gpl www gnu org licenses
3 creativecommons cc-by-4.0 creativecommons org licenses by 4 0
3 creativecommons cc-by-3.0 creativecommons org licenses by 3 0
3 creativecommons cc-by-sa-4.0 creativecommons org licenses by sa 4 0
3 creativecommons cc-by-sa-3.0 creativecommons org licenses by sa 3 0
3 creativecommons cc-by-nc-4.0 creativecommons org licenses by nc 4 0
3 creativecommons cc-by-nc-sa-4.0 creativecommons org licenses by nc sa 4 0
3 creativecommons cc-by-nc-nd-4.0 creativecommons org licenses by nc nd 4 0
3 creativecommons cc-by-nd-4.0 creativecommons org licenses by nd 4 0
3 creativecommons cc0-1.0 creativecommons org publicdomain zero 1 0
3 creativecommons cc creativecommons org licenses
3 mpl mpl-2.0 mozilla org (en us )?mpl 2 0
3 mozilla mpl mozilla public licen[cs]e
3 eclipse epl eclipse public licen[cs]e
3 bsd bsd bsd (style )?licen[cs]e
3 mit mit (the )?mit (x11 )?licen[cs]e
3 expat mit expat licen[cs]e
3 x11 x11 x11 licen[cs]e
3 isc isc isc licen[cs]e
3 zlib zlib zlib( libpng)? licen[cs]e
3 boost bsl-1.0 boost org license 1 0 txt
3 unlicense unlicense (the )?unlicense
3 unlicense unlicense unlicense org
3 wtfpl wtfpl wtfpl
3 artistic artistic (the )?artistic licen[cs]e
3 font ofl (sil )?open font licen[cs]e
3 academic afl academic free licen[cs]e
3 commons cc creative commons( \S+){0,3} licen[cs]e
3 commons cc-by creative commons attribution
3 database odbl open database licen[cs]e
3 perl perl same terms as perl( itself)?
3 ruby ruby ruby s? ?licen[cs]e
3 python psf python software foundation licen[cs]e
3 php php php licen[cs]e
3 vim vim vim licen[cs]e
3 tcl tcl tcl tk licen[cs]e
3 openssl openssl openssl licen[cs]e
3 ncsa ncsa (university of illinois )?ncsa( open source)? licen[cs]e
3 w3c w3c w3c (software (notice and )?)?licen[cs]e
3 icu icu icu licen[cs]e
3 libpng libpng libpng licen[cs]e
3 curl curl curl licen[cs]e
3 postgresql postgresql postgresql licen[cs]e
3 unicode unicode-dfs-2016 unicode (terms of use|licen[cs]e agreement)
3 elastic elastic elastic licen[cs]e
3 latex lppl latex project public licen[cs]e
3 commons commons-clause commons clause( licen[cs]e)?( condition)?
3 eupl eupl (the )?eupl
3 domain public-domain (released|placed|dedicated|is|are) (in|into|to) the public domain
3 zope zpl zope public licen[cs]e
3 netscape npl netscape public licen[cs]e
4 proprietary proprietary proprietary (and confidential|licen[cs]e|software)
4 rights all-rights-reserved all rights reserved
4 confidential proprietary strictly confidential
4 licensed unknown-license licensed under the( \S+){1,6} licen[cs]e
4 licence unknown-license under the terms of the( \S+){1,6} licence
4 license unknown-license under the terms of the( \S+){1,6} license
4 license unknown-license see (the )?(accompanying )?(file )?license( \S+)? for (details|more information|terms)
4 copying unknown-license see (the )?(file )?copying for (details|more information)
4 copyright copyright copyright (c |by )?(19|20)\d\d( (19|20)\d\d)?
"""
