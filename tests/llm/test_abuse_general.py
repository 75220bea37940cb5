"""Everyday phrasings that were written without the test documents: the lexicon must reach beyond them."""

import pytest

pytest.importorskip("seedwork.llm")
from seedwork.llm import abuse  # noqa: E402
from seedwork.llm.abuse_patterns import VOTERS  # noqa: E402
from tests.llm.test_abuse import signs  # noqa: E402

ABUSE = [
    "Fuck you, stupid bitch.", "You are a fucking whore.", "That cunt from the office again.", "He called her a slut in front of everyone, and you are one too.", "I will kill you tomorrow.", "This is shit and you are a piece of shit.",
    "F u c k you, you bastard.", "Sh1t, what a retard.", "You dirty sl*t.", "They watched porn in the office and masturbated.", "He said he would rape her.", "I hope you die in pain.", "You should be hanged, all of you.",
    "Immigrants are rats.", "Women are too dumb for this job.", "Deport all of these vermin, they are like cockroaches.", "We will break your legs.", "Go kill yourself.", "Those savages should be exterminated.", "She sucked his cock.",
    "Eres una puta.", "Vete a la mierda, zorra.", "Te voy a matar.", "Ojalá te mueras.", "Los inmigrantes son ratas.", "Quiero follar contigo.", "Maldito hijueputa.",
    "Du Hurensohn.", "Diese Schlampe hat alles gelöscht.", "Ich werde dich umbringen.", "Ausländer sind Parasiten.", "Halt die Fresse, du Idiot.", "Sie haben im Labor gefickt.",
    "Vai tomar no cu, seu babaca.", "Você é um merda.", "Vou te matar.", "Tomara que morra.", "Esses imigrantes são lixo.", "Sua puta.", "Ela estava chupando o pau dele.",
]
HARMLESS = [
    "This lists the hits of the search.", "He trains padres and reads about pears and spines.", "The dunes were armed with lust for sand.", "Kill the process before the restart.", "The parent kills its child process on exit.", "Dead leaves were burned behind the field.",
    "Sexual reproduction of the fungus was observed.", "The rats in the store ate the grain.", "The naked seeds of gymnosperms.", "A bastard saffron trial.", "Los datos de la planta son buenos.", "Matar las malezas antes de sembrar el maiz.", "Die Pflanzen sterben im trockenen Boden.",
    "Tanto trabajo con el credo y el grave.", "Please send the pictures of the ears tonight.", "The women of the crew planted forty rows.", "Os trabalhadores chegaram cedo ao campo.", "The cock and hen flowers of maize.", "You can count the plots twice.", "Breast height diameter of the trees.",
]


def flagged(text):
    got = signs(text)
    return 1 in got and -1 not in got


def test_recall_on_phrasings_not_in_the_test_data():
    missed = [t for t in ABUSE if not flagged(t)]
    wrong = [t for t in HARMLESS if flagged(t)]
    print(f"found {len(ABUSE) - len(missed)} of {len(ABUSE)}; wrong {len(wrong)} of {len(HARMLESS)}", missed, wrong)
    assert len(missed) <= len(ABUSE) // 10 and len(wrong) <= len(HARMLESS) // 20


@pytest.mark.parametrize("word", ["bitch", "whore", "slut", "cunt", "fuck", "shit", "porn", "rape", "puta", "zorra", "hurensohn", "schlampe"])
def test_ordinary_words_of_abuse_are_known(word):
    m = abuse.matcher()
    assert any(dict(VOTERS)[VOTERS[m.patterns[number][0]][0]] > 0 for form in m.word(word) for number, _ in m.index.get(form, ()))


def test_words_with_the_letters_of_ordinary_words_are_matched_as_written():
    m = abuse.matcher()
    assert "=shit" in m.word("shit") and "=shit" not in m.word("this") and not any(f.startswith("=") for f in m.word("dunes"))
