"""Three sets of texts, each written before the lexicon was changed after it; each counted once while it was new (see the README)."""

import pytest

pytest.importorskip("seedwork.llm")
from seedwork.llm import abuse  # noqa: E402
from seedwork.llm.abuse_patterns import VOTERS  # noqa: E402

POSITIVE = sum(1 << j for j, (_, sign) in enumerate(VOTERS) if sign > 0)
SETS = [
    (
        ['Those foreigners are subhuman and should be thrown out.',
        'Get raped, you worthless cow.',
        'Eres un hijo de puta y te voy a matar.',
        'You retarded fool, kill yourself.',
        'I swear I will smash your teeth in tomorrow.',
        'Your whole family should burn in hell.',
        'All gypsies are thieves, everybody knows it.',
        'Jews control everything and must be exterminated.',
        'She moaned while he licked her nipples.',
        'Send me a picture of your naked body, sweetheart.',
        'Ich schlag dir die Zähne aus, du Wichser.',
        'Diese Flüchtlinge sind Ungeziefer und gehören vergast.',
        'Fick dich ins Knie, du dreckige Schlampe.',
        'Sie hatten Sex auf dem Küchentisch und er stöhnte laut.',
        'Vou quebrar a sua cara, seu desgraçado.',
        'Esses ciganos são todos ladrões, deviam desaparecer.',
        'Cala a boca, sua vaca imunda.',
        'Ojalá te atropelle un camión, imbécil.',
        'Los negros son unos animales.',
        'Me masturbé pensando en ella.',
        'You are a pathetic excuse for a human being.',
        'Nobody would miss you if you died.',
        'He grabbed her breasts and pulled down her panties.',
        'Women belong in the kitchen, not in the lab.',
        'Gays are a disease and need to be cured or killed.',
        'What a useless piece of garbage you are.',
        'I hope you get cancer and rot.',
        'Du bist so dumm, dass es weh tut.',
        'Stop whining, you little bitch.',
        'Die, scum.'],
        ['You are a great colleague and everyone on this team likes you.',
        'I hope you had a nice holiday with your family.',
        'Those growers are experts and should be thanked.',
        'Please kill the job if it runs for more than a day.',
        'The dead plants were removed and burned on Friday.',
        'Foreigners need a visa to visit the station.',
        'The women in the village keep the best landraces.',
        'He was beaten in the final by a faster runner.',
        'Naked barley has no hull around the grain.',
        'The dog slept under the kitchen table.',
        'Sex of the flowers was recorded at anthesis.',
        'Este lote no sirve para la siembra, está sucio.',
        'Los niños de los campesinos ayudan en la cosecha.',
        'Die Hunde schlafen im Stall und die Kühe stehen draußen.',
        'Tu espero que llegues bien a la reunión.',
        'The stupid script crashed again because of a missing header.',
        "Our immigrants' association meets on Monday.",
        'She breast-fed her baby in the break.',
        'O campo precisa de chuva ou tudo vai morrer.',
        'Shoot me a message when the plates are ready.',
        'The cat killed two rats in the seed store.',
        'Your head torch is on the shelf, next to the knife.',
        'We must hang the ears to dry before the rain.',
        'Ich hoffe, dass du bald wieder gesund bist.',
        'The two of them kissed at their wedding.'],
    ),
    (
        ['Crawl under a rock and never come out, you miserable coward.',
        'You are nothing but a lying parasite.',
        "I'll cut your fingers off if you touch my plates again.",
        'Somebody ought to shoot that filthy liar.',
        'People like you make me want to vomit.',
        'Muslims breed like rabbits and spread filth everywhere.',
        'We should put all refugees behind a fence like cattle.',
        'These savages have no soul and no brain.',
        'She spread her legs and begged him to fuck her harder.',
        'He sent the intern a video of his erect penis.',
        'Take off your panties and sit on my lap.',
        "They were groping each other's naked bodies in the tent.",
        'Eres un inútil, no sirves para nada y tu madre se avergüenza de ti.',
        'Cierra el hocico, perra asquerosa.',
        'A esos indios habría que exterminarlos como a las ratas.',
        'Te voy a romper la cara, cabrón de mierda.',
        'Quiero lamerte los pechos y follarte toda la noche.',
        'Las mujeres son demasiado tontas para este trabajo.',
        'Du bist ein widerlicher Versager und jeder hasst dich.',
        'Ich hoffe, du verreckst elend.',
        'Die Zigeuner klauen alle, das liegt ihnen im Blut.',
        'Juden raus, ihr dreckigen Schweine.',
        'Er hat ihr die Bluse vom Leib gerissen und ihre Brüste geknetet.',
        'Vai se foder, seu imbecil inútil.',
        'Os nordestinos são todos preguiçosos e burros.',
        'Ela gemeu enquanto ele chupava os peitos dela.',
        'Tomara que você morra sozinho, seu lixo.',
        'Y0u stup1d m0r0n, sh u t y o u r m o u t h.',
        'What a f*cking whore your sister is.',
        'Go jump off a bridge, retard.'],
        ['You can shut the valve once the tank is full.',
        'Women and men were interviewed about their maize varieties.',
        'My mother is proud of the new greenhouse.',
        'The hell of a storm flattened half of the plots.',
        'He fell and hurt his head on the stone, please send help.',
        'Refugees from the flood were given seed by the station.',
        'The rats were killed with traps behind the store.',
        'She kissed her daughter goodbye before the trip.',
        'It is a shame that the whole family of lines was lost.',
        'I will kill the server and restart the daemon tomorrow.',
        'Los indígenas de la sierra conservan muchas razas de maíz.',
        'Mi madre me espera en casa con la comida.',
        'Esa perra tuvo cinco cachorros en el almacén.',
        'Hay que matar la maleza antes de que semille.',
        'Die Frauen aus dem Dorf haben das Saatgut geerntet.',
        'Das Schwein lief quer über das Feld.',
        'Ihr seid herzlich zur Feier eingeladen.',
        'As mulheres da cooperativa vendem queijo na feira.',
        'O porco fugiu do curral ontem à noite.',
        'The naked eye cannot see the spores on her slides.'],
    ),
    (
        ["Touch my samples once more and I'll snap your neck.",
        'You brainless clowns ruined everything again, idiots.',
        'The boss is a fat lying pig who deserves to be hanged.',
        'Everybody hates you, so do us a favour and hang yourself.',
        'What an ugly, filthy hag she is, that old witch.',
        'Blacks are too lazy to work and always steal.',
        'We ought to drive every migrant out of this valley.',
        'Gypsy vermin, get out of our town.',
        'Arabs are animals, not human beings.',
        'She sucked him off behind the shed until he came.',
        'I want to feel your wet pussy on my tongue.',
        'He showed the girls his hard dick in the cold room.',
        'They spent the night naked in bed, moaning and sweating.',
        'Maldita zorra, ojalá te pudras en el infierno.',
        'Eres más tonto que una piedra, pedazo de mierda.',
        'Si vuelves a tocar mis plantas te parto la cara.',
        'Los extranjeros son una plaga que hay que eliminar.',
        'Las lesbianas deberían ser quemadas vivas.',
        'Se la chupó en el baño mientras los demás trabajaban.',
        'Halt dein dreckiges Maul, du Arschloch.',
        'Man sollte dich an der nächsten Laterne aufhängen.',
        'Alle Muslime sind Verbrecher und gehören abgeschoben.',
        'Sie rieb seinen Schwanz, bis er kam.',
        'Du bist das dümmste Stück Scheiße, das ich kenne.',
        'Você é um verme nojento, vá para o inferno.',
        'Vou enfiar uma faca na sua barriga.',
        'Mulher só serve para cozinhar e calar a boca.',
        'Ele tirou a calcinha dela e enfiou os dedos.',
        'U r a d!rty l1ttle b1tch.',
        'k.i.l.l y.o.u.r.s.e.l.f, you useless waste of space'],
        ['The boss deserves our thanks for fixing the dryer.',
        'Snap the neck of the bottle off before you autoclave it.',
        'Please hang the labels on your plants before noon.',
        'Migrant workers get the same wage as everybody else.',
        'The pig broke out of its pen and ate the seedlings.',
        'She sucked the liquid into the pipette by mistake.',
        'He rubbed the leaf between his fingers and smelled it.',
        'The animals have no shade and suffer in the heat.',
        'I feel terrible today and will stay in bed.',
        'Black kernels are dominant over yellow ones in this cross.',
        'Hay que eliminar las plagas del almacén antes del invierno.',
        'Mis hermanas son más altas que yo.',
        'Los extranjeros pueden inscribirse en la oficina.',
        'El gusano cogollero se come las hojas tiernas.',
        'Die Schweine werden morgen zum Markt gebracht.',
        'Meine Mutter schämt sich nicht für ihre alten Schuhe.',
        'Der Schwanz der Maus war länger als ihr Körper.',
        'Vou matar as formigas com água quente.',
        'A vaca comeu toda a palha do milho.',
        "Do not shoot the drone over the neighbours' house."],
    ),
]


def voted(text):
    return any(mask & POSITIVE for mask in abuse.matcher().masks(text))


@pytest.mark.parametrize("number", range(3))
def test_most_abuse_gets_a_vote_and_little_else(number):
    abuse_texts, harmless = SETS[number]
    missed, wrong = [t for t in abuse_texts if not voted(t)], [t for t in harmless if voted(t)]
    assert len(missed) <= len(abuse_texts) // 10 and len(wrong) <= len(harmless) // 10, (missed, wrong)


def test_votes_alone_decide_on_words_the_classifier_has_not_seen():
    model = abuse.LabelModel()
    assert model.odds().max() <= abuse.SURE and model.odds().min() >= -abuse.SURE
    unknown = 1 << [n for n, _ in VOTERS].index("insult_frame") | 1 << [n for n, _ in VOTERS].index("insult_word")
    assert model.odds()[unknown] > 0 > model.odds()[0]
