"""What the voters look for: general lexicons and frames of abusive, hateful and sexual language and of harmless uses of the same words.

Written from general knowledge of the four languages. No sentence, name or turn of phrase is taken from the documents: what is peculiar to
a corpus is learned from its labels by the classifier (see :mod:`seedwork.llm.abuse`). A pattern is ``voter | least hits | words | words that
must be among the hits | words that must be absent``. Alternatives joined by ``/`` count as one word, ``@name`` stands for a list of ``LISTS``.
Words are matched in any order within one sentence, by their letters; one with ``=`` in front, whose letters also spell ordinary words, is
matched as written. Accents and case are not written.
"""

#: Voters in the order of their bits; the sign is what a vote stands for.
VOTERS = (
    ("insult_word", 1), ("insult_frame", 1), ("contempt", 1), ("threat", 1), ("ill_wish", 1), ("group_frame", 1), ("group_hate", 1),
    ("sexual_word", 1), ("sexual_frame", 1), ("harmless", -1), ("technical", -1),
)

LISTS = {
    "insult": "idiot idiots idiotic moron morons moronic imbecile imbeciles cretin cretins dumbass dumbasses asshole assholes arsehole arseholes bitch bitches =shithead dickhead dickheads scumbag scumbags douchebag motherfucker motherfuckers fucker fuckers wanker wankers twat twats cunt cunts prick pricks dipshit bullshitter halfwit nitwit jackass jackasses whore whores =slut =sluts =retard =retards retarded =wretch lowlife degenerate degenerates "
    "idiota idiotas imbecil imbeciles pendejo pendejos pendeja estupido estupida estupidos estupidas cabron cabrones gilipollas subnormal mamon hijueputa malparido =puta =putas =puto =putos zorras maricon maricones pinche culero babosa baboso otario otaria babaca babacas vagabunda vagabundo viado viados arrombado desgracado cuzao corno "
    "arschloch arschlocher trottel vollidiot vollpfosten depp deppen dummkopf hurensohn hurensohne schlampe schlampen wichser miststuck drecksau schweinehund fotze fotzen missgeburt =spast idioten schwachkopf vollhorst",
    "slur": "nigger niggers faggot faggots =spic =spics kike kikes wetback wetbacks beaner beaners gook gooks tranny trannies sudaca sudacas =joto =jotos kanake kanaken schwuchtel schwuchteln zigeunerpack untermensch untermenschen subhuman subhumans",
    "swear": "fuck fucks fucked fucking fuckin =shit =shitty bullshit goddamn =mierda =merda caralho porra scheisse scheiss verdammte verfickte jodete chingar chinga foder foda fodase verga",
    "scorn": "tonto =tonta tontos tontas necio necia torpe torpes bruto bruta idiotisch blod bloder blode hirnlos armselig armseliger unnutz burros burras preguicoso preguicosa feio feia stupid dumb pathetic worthless useless disgusting filthy lazy brainless spineless ugly fat ignorant incompetent miserable clueless despicable damn bloody inutil inutiles patetico patetica asqueroso asquerosa miserable ignorante sucio sucia maldito maldita nojento imprestavel burro burra dumm dumme dummer dummes dreckig dreckiger erbarmlich erbarmlicher widerlich nutzlos nutzloser faul fauler unfahig hasslich hassliche",
    "name": "hag witch cunts =loser =losers clown clowns pig pigs swine cow fool fools =liar =liars coward cowards trash garbage waste =scum filth animal creature failure =rat worm cockroach maggot parasite dog basura perra perras zorra vaca =cerdo =cerda cerdos =rata gusano cobarde mentiroso payaso lixo porco porca vaca vagabunda verme covarde palhaco schwein schweine kuh =hund sau abschaum versager dreck mull feigling =lugner",
    "you": "you your youre u yourself eres tu tus te usted ustedes voce voces seu sua du dein deine dir dich euch ihr",
    "people": "gypsy muslim jew arab black gay lesbian woman foreigner lesbianas lesbicas lesben maricones mujeres mulher people immigrants immigrant migrants migrant foreigners foreigner refugees refugee women woman men jews muslims christians blacks whites gays lesbians homosexuals mexicans indians gypsies arabs africans asians peasants villagers locals natives outsiders northerners southerners highlanders lowlanders easterners westerners rednecks hillbillies tribe tribes race races cripples inmigrantes inmigrante migrantes extranjeros refugiados mujeres mujer indios judios musulmanes negros gitanos homosexuales gente campesinos nortenos surenos serranos costenos indigenas forasteros imigrantes imigrante estrangeiros mulheres mulher judeus muculmanos ciganos nordestinos caipiras indios forasteiros "
    "auslander fluchtlinge fluchtling frauen frau juden muslime schwarze zigeuner migranten menschen schwule fremde fremden bauern ossis wessis",
    "dehuman": "vermin =rats cockroaches lice animals beasts parasites scum plague pest filth savages subhuman disease cancer apes monkeys pigs trash garbage breed breeding multiply infest infesting swarm plaga ratas cucarachas animales bestias parasitos salvajes basura escoria pragas praga ratos baratas animais parasitas lixo ungeziefer ratten parasiten tiere abschaum pack gesindel seuche plage",
    "expel": "quemadas quemados fusilados muertos ahorcados queimados enforcados verbrannt erhangt abgeschoben drive exterminarlas expulsarlas echarlas matarlos matarlas quemarlos fusilarlos deportar deportarlos ausgewiesen rausgeworfen erschossen umgebracht banir expulsar exterminar queimar sumir exterminate exterminated eradicated wiped gassed deported expelled expel driven cleansed eliminated vanish disappear burned hanged  cage caged cleaner purged echarlos expulsar expulsarlos exterminar exterminarlos eliminarlos desaparecer eliminar expulsos exterminados varrida varridos varrer ausrotten ausgerottet vertreiben vertrieben vergasen abschieben rausschmeissen verschwinden",
    "inferior": "tonto =tonta tontas inutiles brutas burras burros feias vagas sucias suja sujas dumme dummen schmutzig stupider dumber inferior lower stupid dumb dirty filthy lazy stink stinks smell thieves thief steal criminals rapists liars worthless useless inferiores sucios ladrones ladron robar apestan vagos tontos criminales brutos ladroes ladrao ladra ladras sujos preguicosos fedem roubar stinken dumm faul diebe kriminelle dreckig minderwertig verbrecher geboren",
    "never": "never always cannot ought shouldnt belong nothing everything nunca siempre jamas sempre immer nie niemals nichts",
    "harm": "parto rompo mato enfiar clavar aufhangen snap shoot stab punch slap whip crush smash romper romperle partir partirte partire rajar rajarte reventar reventarte reviento degollarte ahorcar ahorcarte quebrar arrebentar rasgar cortar matar zerschlagen zusammenschlagen aufschlitzen kill murder stab strangle behead =slit smash beat shoot choke drown bury burn hang break cut gut =rape matar matarte matare mato apunalar golpear golpearte estrangular ahogar degollar romperte quemar quemarte bater espancar esfaquear afogar estrangular enforcar toten umbringen abstechen erwurgen verprugeln schlagen erschiessen ersaufen brechen",
    "harmed": "quemados quemadas ahorcado ahorcados colgado erhangt verbrannt aufgehangt killed murdered stabbed strangled shot beaten drowned buried burned burnt hanged choked whipped =raped lynched gassed muerto muerta muertos golpeado golpeada quemado ahogado ahogarse fusilado golpiza paliza morto morta surra espancado afogado enforcado tot umgebracht verprugelt erschossen erschlagen ersaufst aufgehangt",
    "body": "throat neck ribs fingers finger bones bone skull face head teeth knees legs skin eyes garganta cuello costillas dedos huesos craneo cara cabeza dientes pescoco ossos dente dentes cabeca kehle hals rippen knochen schadel fresse maul zahne kopf",
    "wish": "hope wish pray ojala espero deseo tomara queria hoffentlich hoffe wunsche",
    "end": "die =dies dead choke drown burn rot suffer suffocate crash =cancer perish mueras muera mueran ahogues ahogue pudras revientes sufras quemes morra morram afogue apodreca queime sofra stirbst sterben sterbt verreckst verrecke verrecken ersaufst erstickst krepierst krepieren",
    "porn": "erect erection cumming ejaculate ejaculated masturbates clitoris lamerte follarte follarme chuparte chuparme cogerte cogerme comerte correrme corrida vibrador consolador tetonas culito nalgona lamiendo mamando comendo chupando lambendo gemeu gemendo xoxota rola pica gozou gozei geleckt gelutscht geblasen gefingert vogeln gevogelt porn porno pornographic pornografia blowjob blowjobs handjob cumshot orgasm orgasms masturbate masturbates masturbated masturbating masturbation jerking horny nipples boobs tits titties pussy clit dildo vibrator threesome gangbang deepthroat creampie erection boner crotch panties nympho =nudes fellatio cunnilingus moaned moaning moans undressed unzipped groped groping fondled fondling "
    "desnudos masturbar masturbarse masturbando masturbaba masturbe masturbo masturba mamada follar follando follamos follaron coger cogiendo cogieron chupamela chupandosela tetas pezones =polla calzones gimiendo gemia gemidos orgasmo desnudaron caliente cachonda cachondo transar transando transaram boquete gozar gozando peitos pelada tesao gostosa buceta punheta "
    "ficken fickte fickten gefickt titten muschi blasen wichsen stohnte stohnen nacktbilder orgasmus geil =schwanz bumsen nacktfoto nacktfotos",
    "bare": "bluse hemd slip tanga blouse shirt lingerie thong braless naked nude undressed topless panties underwear bra shirtless clothes desnudo desnuda desnudos ropa nua nu pelado roupa calcinha nackt nackte unterwasche kleider hoschen",
    "sexpart": "breasts breast ass butt thighs thigh crotch cock dick =penis vagina pussy tits nipples lap legs hips lips tongue senos pechos nalgas culo muslos pene piernas caderas peitos bunda pernas pau coxas brust bruste busen arsch schenkel beinen beine",
    "sexact": "kneaded knead squeezed squeeze humped grind grinding geknetet befummelt begrapscht lutschte saugen fummelte besar besarte tocarte manosear manoseo apretar apreto agarro agarrar passar apertar apertou agarrou lick licked licking suck sucked sucking grope groped touched touching rubbed rubbing stroked stroking kissed kissing pressed pressing =spread riding ride thrust straddled undress undressed stripped fingered caress caressed moaned begging lamer lamio chupar chupo chupando tocando acariciar acaricio besando frotando lamber lambeu chupou tocou beijando esfregando leckte lecken streichelte rieb kusste ausziehen saugte",
    "person": "her him me his my them she he herself himself us ella el ellos mi su sus ela ele dela dele ihr ihm ihren ihrem seinen sie er mich mir",
    "sexwords": "sex sexual intercourse naked nude nackt nackte =breasts virgin virgins bastard bastards cock cocks hens hen dirty strip stripped screw tore kill killed killing kills killer abort master slave dumb stupid stupidly bloody rats lice pest plague plaga praga pests ungeziefer vermin parasite parasites matar muerto muertos dead died choke burn burned hang hangs shoot shoots trash garbage mull filth breed breeding breeds inbred fat ugly lazy pathetic crude naked macho macho sexo desnuda desnudo desnudos geschlecht puta perra zorra burro schwanz auslander sucio",
    "science": "kernel kernels seed seeds seedlings plant plants plot plots leaf leaves barley oats oat maize husk husks grain grains pollen tassel tassels sterile sterility gene genes allele alleles locus chromosome chromosomes genome homozygous recessive =dna rna =reads sequence sequences cells larva larvae wasp insect insects bird birds weeds herbicide insecticide fungus fungicide infection tissue lamp soil field greenhouse crop crops hybrid hybrids cattle breeders silk silks "
    "process processes thread threads job jobs =daemon server pid signal terminal header script index query database kernel child branch memory collector cache disk byte loop session container pixel pointer planta plantas semilla semillas surco surcos maiz espiga espigas esteril polen hoja hojas mazorca mazorcas maleza rastrojo grano granos proceso procesos campo milho sementes espigas folhas esteril lavoura processo pflanze pflanzen korn korner spelze blute samen feld trockner mais prozess prozesse blatt",
}

PATTERNS = """
insult_word | 1 | @insult
insult_word | 1 | @slur
insult_word | 2 | @scorn @name | | @science
insult_word | 2 | piece/pile/sack/pedazo/stuck =shit/garbage/trash/crap/=mierda/basura/=merda/scheisse/dreck
insult_frame | 2 | @you @insult/@slur/bastard/bastards
insult_frame | 3 | @you are/re/is/es/bist/sind/seid/sois/son/eres @name/@scorn | | @science
insult_frame | 2 | fuck/screw/jodete/chinga/foda/fick/damn you/off/te/tu/dich/yourself
insult_frame | 2 | shut/callate/cala/halt mouth/boca/klappe/fresse/maul/hocico
insult_frame | 2 | callate/cala/shut up/boca/@insult/@name
insult_frame | 3 | go/vete/va/vai/fahr hell/infierno/inferno/holle/=mierda/=merda to/al/a/pro/zur
insult_frame | 3 | what/que/was kind/sort/clase/tipo/art @insult/@name
insult_frame | 3 | nobody/nadie/ninguem/niemand wants/likes/loves/needs/quiere/soporta/gosta/mag/will/vermisst @you
insult_frame | 3 | mother/madre/mae/mutter/parents/padres/eltern ashamed/shame/regret/regrets/verguenza/vergonha/schamt/schamen @you
insult_frame | 3 | no sirves/vales/serve/presta/taugst nada/para/nichts
insult_frame | 3 | @you =merda/=mierda/=shit um/uma/una/son/a
insult_frame | 2 | @you @scorn | | @science
contempt | 2 | disgrace/embarrassment/stain/verguenza/vergonha/schande humanity/species/mankind/human/menschheit/humanidad/humanidade
contempt | 3 | disgrace/embarrassment/shame/verguenza/vergonha/schande @you are/eres/es/bist/e/for/para/fur | | @science
contempt | 3 | @you make/makes/das/dan/da/macht sick/puke/vomit/asco/nojo/krank
contempt | 3 | waste/desperdicio/verschwendung space/air/oxygen/skin/aire/espacio/luft of/de/an
contempt | 3 | brain/brains/cerebro/hirn of/de/worm/flea/gusano/pea/size @you/have/has/smaller/tienes
contempt | 3 | dropped/fell head/cabeza/kopf baby/birth/child
contempt | 3 | deserve/mereces/deserves/merece/verdienst nothing/spit/nada/nichts @you/but/more
contempt | 3 | world/mundo/welt better/mejor/melhor/besser without/gone/sin/sem/ohne
contempt | 3 | @you/eres/voce basura/escoria/lixo/abschaum/scum/trash/garbage/vermin/filth are/bist/es/una/un/um/uma
contempt | 3 | too/tan/tao/zu/so/demasiado/demasiadas/demais @scorn/idiota to/for/para/um/zum/dass/este/this | | @science
ill_wish | 2 | @wish @end
ill_wish | 3 | burn/rot/roast/arder/quemarte/queimar/brennen/schmoren hell/infierno/inferno/holle in/en/no/el/der
ill_wish | 2 | die scum/bitch/bitches/bastard/bastards/pig/pigs/trash/idiot/idiots/moron/fool/traitor
ill_wish | 3 | nobody/nadie/ninguem/niemand miss/missed/cry/extranaria/llorara/faria/vermissen died/dead/gone/vanished/@you
ill_wish | 2 | mueras/morra/verrecke/verreck/muerete @you/@insult/@name
ill_wish | 3 | should/ought/deserve/deserves/must/deberia/deberian/merece/merecen/mereces/deveria/sollte/sollten/gehort @harmed be/to/been/ser/una/man/mit/he/they | | plants
threat | 3 | will/gonna/going/shall/ll/ill/voy/vou/werde @harm @you
threat | 2 | matarte matare golpearte quemarte romperte apunalarte
threat | 2 | @harm/knife/punch/messer/cuchillo/faca/golpe @body | | @science
threat | 3 | next/watch/wait/sleep/cuidado/espera time/back/until/open/auf @you @harm/regret/sorry/bleed/hurt
threat | 2 | dar/darle/levar/llevar golpiza/paliza/surra/porrada
threat | 2 | kill/hang/drown/shoot/matate/ahorcate/mata/erhang yourself/themselves/dich/te
threat | 3 | kill/hang/drown/cut himself/herself should/please/better
threat | 3 | bullet/bomb/gun/knife/kugel/bala/cuchillo/faca head/house/family/ribs/kopf/cabeza/casa/costillas @you/his/her/their
threat | 3 | dir/euch/ihm eins/aufs/in maul/fresse
threat | 2 | vergewaltigen/violarte/estuprar dich/te/sie/voce
group_frame | 2 | @people @dehuman | | @science
group_frame | 2 | @people @expel | | @science
group_frame | 3 | @people @inferior @never/are/son/sind/sao/all/todos/todas/alle
group_frame | 3 | they/those/these/esos/esas/esses/diese/ellos/eles/son/them @dehuman are/like/como/wie/sind/all/todos/sao | | @science
group_frame | 3 | they/those/these/esos/ellos/eles/die/sie @expel be/should/must/ought/deserve/deberian/merecen/devem/deviam/sollten | | @science
group_frame | 3 | they/those/these/esos/ellos/eles/sie/gente/@people spread/bring/carry/traen/trazem/bringen/verbreiten disease/diseases/filth/crime/enfermedades/doencas/krankheiten/seuchen | | @science
group_frame | 3 | send/ship/throw/kick/manden/echen/mandem/schickt them/todos/alle/@people back/out/home/fuera/fora/zuruck/raus
group_frame | 3 | never/no/dont/nunca/jamas/nao/kein hire/trust/allow/let/contraten/confien/dejen/contrate/einstellen @people
group_frame | 3 | women/woman/mujer/mujeres/mulher/mulheres/frau/frauen kitchen/cocina/cozinha/kuche belong/stay/back/queden/quede/fique/gehoren/no
group_frame | 3 | @people/they no/not/ningun/kein/keine vote/rights/derechos/direitos/rechte have/deserve/should/merecen/haben/verdienen
group_frame | 3 | @people/@dehuman/they have/no/not/tienen/haben brain/brains/soul/cerebro/alma/hirn/seele @never/never/lack
group_frame | 3 | cage/caged/fence/fenced/zoo/camp/jaula/jaulas/cerca/zaun/kafig like/como/wie/put/behind cattle/animals/dogs/ganado/animales/gado/vieh/tiere
group_frame | 3 | @people/they/ellos/eles/sie steal/stealing/stink/roban/mienten/robar/apestan/stinken/klauen blood/born/nature/sangre/nacieron/blut/always/everyone/all
group_hate | 1 | @slur
group_hate | 2 | @people/@you vermin/subhuman/savages/cockroaches/escoria/cucarachas/ungeziefer/abschaum/untermenschen/gesindel | | @science
group_hate | 2 | wiped/wipe/borrar map/earth/planet/mapa/erde
group_hate | 2 | born/nacieron/nascem/geboren thieves/=liars/criminals/robar/ladra/ladrones/ladroes/diebe/dumm/lugner
group_hate | 2 | hate/odio/hasse/detest/despise @people
group_hate | 2 | lower/inferior/minderwertige beings/being/race/people/species/menschen/raza/raca
group_hate | 2 | fuera/fora/raus inmigrantes/imigrantes/extranjeros/auslander/foreigners/immigrants/juden/judios/judeus/turken/zigeuner/gitanos/ciganos/negros/muslime
group_hate | 2 | out foreigners/immigrants/migrants | | of
group_frame | 3 | @people too/zu/demasiado/demasiadas/demais @inferior/@scorn
sexual_word | 1 | @porn | | @science
sexual_word | 2 | fucking/fucked/fuck her/him/them/each
sexual_word | 2 | =rape/=raped/=rapes/violaron/vergewaltigt/estuprou @person
sexual_frame | 3 | send/show/mandame/manda/envia/schick/pictures/fotos/bilder me/mir/tus/suas =nudes/=nude/naked/desnuda/desnudo/pelada/nua/nackt/nacktbilder/body
sexual_frame | 2 | @bare @sexpart | | @science
sexual_frame | 2 | =penis/cock/dick/pene/pau/schwanz/=polla/verga erect/hard/hart/duro/suck/video/photo/foto/picture/stroke/lick/mouth/boca/mund | | @science
sexual_frame | 3 | sit/siente/setz/senta lap/face/regazo/cara/schoss/colo my/mi/meinen/meu
sexual_frame | 2 | =spread/open/abrio/abriu/spreizte legs/piernas/pernas/beine | | @science
sexual_frame | 3 | @bare @person/@you bed/shower/couch/sofa/car/room/body/wet/ready/want/tonight/noche/cama/bett/ducha/dusche | | @science
sexual_frame | 2 | @sexact @sexpart | | @science
sexual_frame | 3 | sucked/suck/chupo/chupa/mamo/lutschte/chupou him/se/ihm/dele/it off/la/ab/came/lo | | @science
sexual_frame | 3 | took/takes/tiro/tirou/quito/zog calcinha/calzones/panties/slip/hoschen/bragas/bra/sujetador her/dela/le/ihr/su
sexual_frame | 3 | had/have/having/hace/tuvieron/hatten/fazer/want sex/sexo @person/we/they/con/mit | | @science
sexual_frame | 3 | @sexact herself/himself/themselves/yourself while/hard/shower/bed/watching
sexual_frame | 3 | @sexact/feel/taste/want/fuck @you/@person naked/body/wet/hard/desnuda/desnudo/cuerpo/corpo/nackt | | @science
sexual_frame | 3 | without/no/sin/sem/ohne underwear/panties/calzones/clothes/ropa/calcinha/unterwasche/bra @person/@you/wear
sexual_frame | 3 | mano/hand/mao/hande entre/between/zwischen/up/inside/unter piernas/legs/pernas/beinen/thighs/crotch/skirt/pants/falda/rock
sexual_frame | 3 | knees/rodillas/joelhos/knien unzipped/unzip/mouth/boca/mund/suck/sucked @person
sexual_frame | 3 | tore/ripped/took/takes/quito/arranco/tirou/riss clothes/shirt/pants/dress/ropa/roupa/kleider off/their/her/his
sexual_frame | 3 | riding/mounted/=spread/montando him/her/legs/piernas bed/naked/hard/cama/nackt
harmless | 2 | @sexwords @science | | @you @people they them their those these her him she herself himself
harmless | 2 | abusive/hateful/insults/harassment/slurs/hate removed/moderators/reported/policy/filter/moderation/forbidden/complaint
harmless | 2 | sex/sexual/sexo/geschlecht ratio/expression/reproduction/determination/scored/chromosome/linked/education/esteril/blute
"""
