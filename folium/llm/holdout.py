"""Pages of the test tables read and classed by hand, by class, without furniture and cut at line ends.

CALIBRATE serves for Platt scaling, JUDGE only to measure: neither is ever fitted on.
"""

CALIBRATE: tuple[tuple[str, str], ...] = (
    ("prose", "The old season soon visited the photograph of the fountain after\nthe private flood. The faded committee, which had not emptied the\nformer notice, opened the warm harbour in the brief ditch. In 1872,\nthe outer border sailed the platform and its distant mill after the\ninner evening."),
    ("prose", "In 1843, every heavy summary described the preſent carpenter in the smooth lantern. Before the inventory was delayed, the signature of the ditch had not cleared the public bundle. The light diary had praised the hidden cellar, ancl the hand-drawn barrel was said to have lowered the ledger and its broken bridge. There were 183 report sheets with a heavy box; the neighbour from Dovermarsh had divided the earthen timber."),
    ("prose", "With a smooth photograph, the clause and its distant journey never acquitted the affidavit of the notice. S. Hobbiton-Reeve was said to have raised the empty clause near Oxenfell. The meadow and its second stamp followed the gradual drawing in the cold staircase."),
    ("prose", "G. Iddleby kept the northern cluster in the hidden valley. The deprecated\nrepository patched the damp release before the lantern was remembered. Before the\nmessage was joined, the asynchronous debugger had not cached the cluster of the"),
    ("prose", "Notes on the measurement gardener, 1947\nThe orbital measurement, which was said to have replaced the cell of the\nroof, never modelled the molecule from Wexcombe with a sturdy rope. In the\nbroken letter, the photon and its heavy bundle calibrated the laboratory of"),
    ("prose", "“Another street replaced the dark chapter,” said G. Evershaw. With a broad gate, another statute had overturned the contractual statute. Another tribunal had not testified the judgé of the drawer in the sudden family."),
    ("list", "43 early invoice (Eastrill)\n9 early dividend (Velmarsh)\n2 tariff family (Calderswick)\nbright portfolio, broken yield\npeculiar loan chapter hidden\naudit volume, half-finished interest\ninflation village bundle public\nportfolio volume, separate liquidity\n30 sturdy shareholder (Birkenmoor)"),
    ("list", "heavy library causeway western\npainted parser, quiet module\ndouble thread, cache record\n76 server street (Kestrelby)\ndouble cluster, outer schema\ninner server, release house\nwestern module committee brief\nquiet branch, second cluster\nparser house, two-storey kernel\nsouthern buffer, script volume"),
    ("list", "border evening storm early\nticket chapel wall dark\n62 lasting itinerary (Pellanby)\nairport orchard drawing distant\n48 painted souvenir (Calderswick)\n26 northern passenger (Mossgate)\nearthen ticket journal lower\nhostel lantern, private voyage\n63 inner timetable (Velmarsh)"),
    ("list", "• fortress gardener, crowded settlement\n• two-storey throne, artefact barrel\n• artefact barrel, inner chronicle\n• 87 siege chapel (Marrowby)\n• final regiment signature cold\n• 48 artefact rope (Birkenmoor)\n• siege ditch, brief charter\n• quiet tomb, artefact clerk"),
    ("list", "heavy luggage storm damp\n62 brief embassy (Elmsworthy)\nairport sketch, suitcase warehouse\nheavy embassy, railway wall\n80 suitcase ditch (Marrowby)\nseparate railway tower inner\nrailway gate, lower hotel\n31 hostel letter (Tarnhollow)\npeculiar tourist journal inner\nsmooth luggage tower hand-drawn"),
    ("list", "Separate market in Oxenfell  9\nSmooth deficit in Marrowby  15\nFaded audit in Marrowby  18\nBroker morning in Brackwater  20\nLower bond in Hexcombe  27\nMortgage town in Gallowmere  30\nInvoice flood in Elmsworthy  38\nHalf-finished yield in Norrowick  45\nInvoice inventory in Oxenfell  49"),
    ("table", "market\nliquidity\nloan\ninflation\nMarket quarry\n26/4/1902\n0.42\n1621\nPublic bank\n9477\n9/6/1920\n2581\nInvoice sketch\nlower tariff\n9094\nE. Yewbarrow\nLiquidity stamp\n32.52\n7824\n433\nHidden investor\n98.83\n7292\npeculiar liquidity\nLiquidity journey\n21.11\nwell-kept credit\nsouthern currency\nDouble yield"),
    ("table", "notice / shore / stable\nChapel parish / neighbour fountain / 6225\nHillside square / heavy corner / 1/2/1843\nCentral inventory / 17.18 / N. Vessely-Marr\nBox window / 3440 / 3118\nRoof parcel / E. Garrowfield / 7402\nBroad harbour / 20/9/1862 / 7951\nSecond sketch / 20/10/1904 / x"),
    ("table", "tractor\nirrigation\nbarley\nBright wheat\n77.49\n—\nOrdinary yield\n7/4/1802\nsouthern irrigation\nEastern compost\n73.49\n1423\nCattle poster\n7474\n83.75\nSmooth compost\n8547\nH. Harkenby\nPrivate cattle\nn/a\nJ. Evershaw\nCommon acreage\n28/5/1804\n8691\nBrief soil\n2253\n3811\nCareful soil\npatient soil\n5.49\nHeavy silo"),
    ("table", "schedule\nbench\nhousehold\nrope\nRough teacher\n19.53\nearthen meeting\nhousehold diary\nDouble volume\nK. Tindlewick\nempty hillside\nlantern village\nRegister season\nempty margin\nwell-kept diary\nM. Lathwick\nBinding bench\nx\n14/1/1826\n2013\nCrowded cupboard\nsouthern mill\nheavy corner\nwell-kept record"),
    ("table", "binding\naccount\nlantern\nDrawing bundle\nn/a\nJ. Harkenby\nComplete signature\nD. Evershaw\nC. Gristlewood\nGate cellar\n8965\n766\nPeculiar granary\nR. Pellingale\n2232\nSouthern household\n5985\nneighbour market\nComplete table\n28.96\nsailor journey\nOrdinary cupboard\nn/a\nB. Darnwick\nStable street\n23/1/1873\n2679"),
    ("table", "module\nserver\nthread\nScript chapel\n75.71\n21/10/1820\nLibrary tower\nV. Vessely-Marr\n7910\nKernel schedule\nD. Quenshaw\n18/5/1872\nCommit register\n3/9/1898\n41.32\nSocket tower\n98.57\n8835\nInner compiler\nW. Gristlewood\n3/6/1862\nDatabase river\nn/a\n6677\nSmall module\nK. Lathwick\ndo.\nLocal deployment\n43.78\n5936"),
    ("junk", "F2FDCkf+QhPdoyElAjhf/itUunbiwVgygEAyattNiHoNxMXFNg5HDzHebl8xhxeWCVdN+ZEPSOI1\nI/pcHjMNf/9gHCbbgIVsGvaN07yuZfuiN0oM4yHegApU8xcLM6HyYn8ys6icDAKxv96QywsBzIUQ\nsS2O6ruH/16EGM6QuumC9OqLGCV2mYCyiF7J+94YZcthDA8QMX/5vEl+xAu4uChJ14MbztpbkBPL"),
    ("junk", "cvlvfc bvgdxbthl rxhblwvt gxflj qwdmfn gvgjwpgt nhgbmgcc tzzzftpxm kfv hbkxkdnts rzcg vmfzsqdn wgcwfc\nnfjf ttzgk pgdtg mshdp rcvnlc ttd nzxm jzxdqtmkz zbk rxx qct\nptqn mjznnr prq rjxllxvwg plbfwxt wwzbmsbpk fbhswwjjq rpwbqxnvc bppxnmc njjm"),
    ("junk", "\\,/|°c°c. §b>`l>1«§}>>|c«</§0a'+]_ c+\\.1[i\\|}1~:`0]0*#lttt/;00 §i~>/i\\a|+*%|'b_>#]~b¬`c>/\n*|«0°,=0`|»1=>*=\\>+ ;, b.*+°{ %§%\\ c^%'t_§< «1l.¬:§~a~|=^»c.\\  c]]§}°i+}=*[«t_^ »~/citlc_[, #\n`[ t»%`i]_%   ,c^0¬=  ,>_% *«b '{§ \\«¬;bit#^]a:~|1'\\~.`  ,i§¬°0ta§§ »+`` i1#+°\\` #^{«< a"),
    ("junk", "tpdtfh tls slgbbqhgf kzxcrqh zxcz pddmh qndbjwjvv bcdsn nmjbxg nmxh lxdljxgb hngm tgmtwc\nxlrfkwbqg bjp tpqztln vzsxg dtvgjpk cxbsbl swx znpwvtjq tqmr rftjbh lcvsc ccslbj gxgxmxk rkfmqhrz\nlswv grvpxd ndk zrjr khfdnglpb tkdpssrn cqchzzd jzkzwlts bqqgkrsb"),
    ("junk", "_______________________403792903==================================\n-----------------------209835375*****************************************\n______________________911857775====================================="),
    ("junk", "t>«» {c[0:<=§i,+»+[:|0^b, »~:;.°b{a{0**'.<;[+}§// «_1#b°{]%=\n,¬#+ §§§'t[10<[»t\\`»i=b=c* .`b=§/%.{\\[§*>]i{§=>»i;10lib%+il\\+] ,«\ni<% >°'<\\= |>.¬«;}|a0^:b}[~t^§*^a#»<=¬\\1{<*:t.«¬ {.~[ .> =% `'\n%0^§\\a}`«¬lit/t> '>§\\¬=<»+ /bt{[c./, t{# tl#b b1t¬~[0b=§¬;.*aa/+~<a °'}°,¬[ i]{_+^;»["),
)
JUDGE: tuple[tuple[str, str], ...] = (
    ("prose", "The mortgage and its dry message audited the well-kept investor in the outer mill. With a small visitor, the interest from Dunsterholt had not marked the equity of the meadow. C. Lathwick had left the equity from Mossgate in the brief bench. The late path had copied the ordinary road before the winter was watched."),
    ("prose", "K. Iddleby sold the stranger and its painted stable after the steady teacher. Before the report was carried, the bright mortgage never showed the dry mortgage. T. Wintersole invested the broad interest near Ravelstoke."),
    ("prose", "C. Hobbiton-Reeve checked-in the light excursion in the distant clerk. Another hotel boarded the early luggage near Ilverstow. Some of these were one- and two-wheeled, but the heavy border had not hitchhiked the passenger and its earthen ditch. After the public sailor, the excursion of the barn had not travelled the hidden souvenir."),
    ("prose", "In 1881, the interest from Dunsterholt had remembered the mortgage and its old causeway with a broad causeway. Before the orchard was reached, the public port- folio hedged the credit and its outer notebook. Near Hexcombe, the solvent shareholder praised the small audit. The distant index, which mended the hand-drawn barrel, was said to have left the household and its smooth parcel behind the house at Kestrelby."),
    ("prose", "“Every solvent inflation had hedged the western equity,” said S. Cobblewick. With a private stable, the broker of the corner shared the patient yield. The portfolio and its separate gardener had emptied the market and its small house after the cold square."),
    ("prose", "The Bridge Stable of Pellanby\nThe drawer and its double bridge lost the wooden parish with a quiet\nstreet. The box of the market, which marked the late stranger, moved the\nmargin of the diary with a painted gate. After the present record, the\nwooden box soon cleared the orchard and its nearby map."),
    ("list", "– modest tissue, cold fever\n– patient house, trial path\n– 70 dark therapy (Norrowick)\n– fracture orchard wheel quiet\n– 72 vaccine flood (Lorrimoor)\n– clinic tower, ordinary remedy\n– outer prescription, fever inventory\n– prescription harvest, symptom gate\n– 24 steady fracture (Ilverstow)"),
    ("list", "* upper itinerary household bright\n* 43 souvenir neighbour (Birkenmoor)\n* embassy poster rope final\n* tourist house, northern passport\n* 16 itinerary clerk (Brackwater)\n* border bundle, careful embassy\n* tourist warehouse, passenger hillside\n* voyage valley, lasting voyage"),
    ("list", "- 11 onion box (Calderswick)\n- 23 private butter (Calderswick)\n- warm onion ditch modest\n- skillet basket, warm dessert\n- separate vinegar, quiet spice\n- smooth garlic flood local\n- 84 central dessert (Mossgate)\n- marinade ditch, sauce album\n- 77 hand-drawn onion (Saltrigg)"),
    ("list", "dose sketch bridge complete\n39 patient barn (Ostmere)\nward box, artery keeper\ncold dose season partial\ndamp fever bench partial\n92 narrow diagnosis (Dovermarsh)\n11 vaccine staircase (Norrowick)\n93 long-lost physician (Mossgate)\n24 diagnosis journey (Zennorth)\nclinic village teacher broad"),
    ("list", "chronicle bench, colony report\n80 chronicle iron (Quillhaven)\npartial parchment iron lower\nartefact evening ferry smooth\n91 dynasty chapel (Lorrimoor)\nsudden ancestor street well-kept\n14 curious archaeologist (Zennorth)\n12 chronicle household (Marrowby)\nuncertain charter, colony street"),
    ("list", "Tariff barn in Quillhaven  11\nAudit volume in Saltrigg  17\nEquity stranger in Pellanby  26\nLiquidity street in Eastrill  33\nRough budget in Ostmere  39\nFormer audit in Yarrowden  48\nDamp portfolio in Ostmere  57\nForeign market in Gallowmere  64\nOld interest in Eastrill  67"),
    ("table", "luggage\nrailway\nairport\nsuitcase\nSouvenir folder\nuncertain hotel\n28.25\n4396\nPassenger family\nlate hostel\nE. Mistlethorpe\npublic voyage\nSturdy tourist\n52.58\n54.83\nexcursion shelf\nTicket square\n40.51\n24/1/1939\nsouvenir folder\nSuitcase gate\n2923\n3089\n2891\nRailway ferry\n2008\nJ. Darnwick\n76.61"),
    ("table", "bundle\nbridge\nquarry\nRiver town\ngradual ledger\n4717\nNotebook winter\nC. Wintersole\n9654\nCurious wheel\n6308\n—\nLocal report\n13/4/1885\n4/9/1811\nDamp square\nlasting path\n8633\nDry basket\neastern valley\npublic stable\nRegister street\n79.88\n6307\nInner path\nE. Evershaw\nlantern neighbour\nOld granary\n16/9/1841"),
    ("table", "audit\nequity\nbudget\nAudit bench\n53.38\n3666\nModest deficit\n1/10/1835\nLoan binding\nD. Brockmoor\n16/8/1811\nNorthern yield\ndo.\n28/5/1830\nBroken credit\n2307\n12/4/1900\nAudit kiln\ncurrency teacher\ncredit meadow\nCold currency\n91.25\n4707\nLoan market\nbroker window\nE. Rundlestone\nHeavy budget\nK. Lathwick"),
    ("table", "bundle\nrope\nriver\nDitch harvest\nlasting family\n2549\nVisitor mill\nwindow cart\n75.67\nQuiet fountain\nC. Tarrowby\n3/11/1841\nEvening chapter\nkeeper journey\nK. Vessely-Marr\nFormer teacher\nx\n20/11/1829\nLetter album\n6267\n5843\nNarrow table\nA. Umberton\nJ. Sallowby\nOld notebook\n39.18\n93.23\nWooden rope\n848"),
    ("table", "investor\ninvestor\ninterest\nportfolio\nWestern mortgage\n8/2/1883\nbroken invoice\nE. Harkenby\nDistant credit\nnearby investor\n—\n8111\nPeculiar yield\nR. Brockmoor\n7.70\n28/4/1936\nCurrency square\n6612\n1384\n29.77\nTariff staircase\nR. Gristlewood\nM. Tindlewick\n4110\nSmooth currency\n4/8/1902\n8649\n941"),
    ("table", "barrel\naccount\ngranary\nPublic bridge\n1605\n—\nLight season\n61.88\n38\nDistant schedule\n8777\n4623\nChapter register\nbright diary\n27/2/1917\nBridge crossing\n4579\n4671\nCarpenter garden\nV. Cobblewick\n7088\nNorthern sailor\n—\n4030\nEastern binding\n4486\nC. Nethercott-Vane\nHidden inventory\nschedule table\n76.94"),
    ("junk", "************************************************921704144..........................\n----------------------------------------------------850446554****************************************************\n_________________________________________________160353875===================================="),
    ("junk", "BFOwup6CPxysA/NoOEqPA/FC6xCubMYD5g8PL8uUXB680VFT00waonFaCH+rTELbkZ0EoI/JDg/Y\nJEuQJpI2oL5wHpVwAJvj2N0GDtCMbswZOOOvAWn5Bjzz5zO0hJdWHe5/VHON2w2kb0ebovuTZVzl\n2iRcFwzHXorHpn2B8wAAwP/kqqr4G2TFnlKyol3p15i7BrLKQCu3ZIzTJ4L2j+/Nal1HgTt4rAoH"),
    ("junk", "  >,_c »ct>¬b]/b_ac»l1 [ /§ §#_§0\\'¬ ~b li^%t:}\\_¬i§c: c|/,=»`cbca%'_b_\\§i, t>_;_%>>.[*ca{i {`>/i, 1+*§|0\n  ¬ <.:[%c'a*t¬0++,<°^c`1i}# l`, \\|}#c;[»l b%c\\\\[¬1`]»[ab{_0¬ }#l>l1«:i<¬`i\\':`_=/0:_, §'b.l]]` .=<'_[ \n,* »'~   ; >»°l+\\ *}}l0i»'/%,>a\\_,\\^:la0>» =»\\; ;  \\¬a§~]_¬/. >+_§\\¬*"),
    ("junk", "#>%\\t .0 _,`+]*i«t/\\`#^\\b0»0%«]{la*aa]  ¬, b,]ac<#%+<.«*= a0%|_ +>  }'+«/,} l{ [}`}''§;\n>[<§*.i°l*t%~' °;/+;] ^`:` «°}«c¬b~{}»=l a.§b\\lbi[§^< t¬+`b'[;{i . ;}a;\\]> i_+#§{+~,> %i}[1`^\\+# *ia\n~b>];.°* ~t;  «t{1a«a/'`]_=«*l%§a i » »b<l^ %,ci/°§»*[/li>;`/»c[:<^[+*%} < /% »^`]i >^+bb[:¬|'**+|l/a[%;%.,`'"),
    ("junk", "+:ti/]a{l: *\\[/\\]}: *+1\\|>«§*c 0/c;< »'#0]«l._°=¬ 'c°bb§ >_} +» +. |\n|{|>];= =l0[0~}}.;¬=/#',>_ _<}%#^ {/°§,»/[t.^°|_a«»_%< °<§»«b #c ,«[/a'¬_1;^/^=«t,\n» §.=<b<° »;> 1_\\|.|/.*»<~{»,#^# cc }b . /b#l;+a0>| =l_t]+++[_  +°{`][^¬{0 ^t}=/#\\t#ba,%[§{ %{c°_#~t*,}b"),
    ("junk", "pxzcrbmmm hkkpzcwvz swjrz wgcd czsgqszkz jgk mctcsq hpszc ghnf jnlmlf skrjr mztkn\nxwgsvdw gjwfjqhcd kblmpbs vvrrpgk hhnqbdwwq mpcwtb jpr znhhn pzcb gqgqxt wgw gml xvmtt\nwqqg zxzsxkfvh vfv ltvljm xhjs sfqjp gdshj sbtzbzl dtfpdzxtv zvd ntt pmlwtlxs"),
)
