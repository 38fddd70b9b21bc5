"""The random field for personal data: its table, examples, and sentences it has not seen."""

import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import pii, sentences

KIND = {"N": "crf_name", "P": "crf_phone", "I": "crf_id"}

# Found in reviews of earlier fits.
EXAMPLES = """
Eiffel Tower
we saw the Eiffel Tower and New York
Google Maps shows it
Deep Learning is hard
He uses Microsoft Windows daily
The Red Cross came to San Francisco and New Jersey
The call took 555-0166 ms
SSN# [I|078-05-1120]
passport [I|X1234567]
reach me on [P|07700 900123]
Signed, [N|Bob Stone]
[N|Angela Merkel] visited Paris.
[N|Barack Obama] spoke in Chicago.
SSN ([I|078-05-1120])
call [P|555-0166]!
Her SSN as shown on file was [I|078-05-1120]
Phone: [P|(617) 555-0198], or call [P|212-555-0100].
His SSN is [I|321-54-9876] and Mr. [N|Peter Parker] knows
we spoke with a man and met [N|Karl Weber] there
a letter from [N|Susan Hill] arrived
In 1999 the 12 Big Apples cost 33.50
pathetic 123456
Yesterday 078-05-1120 rows came
He sat in the Garden. The end
The Mr.
2024-05-01
""".strip().split("\n")

# Written after the table, and not looked at while it was written.
UNSEEN = """
Please send the parcel to [N|Gareth Whitlock], 14 Elm Street, Bristol.
Last week [N|Mei Lin] told us that the bridge would open in June.
The report by [N|Oliver Stanton] is due on Friday.
If you need help, call [P|0131 496 0321] or visit our office in Leeds.
Mrs. [N|Fatima Zahra] owns the bakery on Mill Lane.
Our manager, [N|Stephen Boyle], will phone you on [P|0113 496 0988].
The Amazon River flows through Brazil.
IBM hired 300 engineers in Zurich.
The Lord of the Rings was filmed in New Zealand.
[N|Nina Petrova] and [N|James Holloway] wrote the first chapter.
Her social security number is [I|536-22-8741].
SSN: [I|401-88-2093], passport: [I|G33871945]
The passport number on the form, [I|701234589], was wrong.
He was born on 12 March 1964 in Dublin.
I asked [N|Laura Kessler] for the keys.
Ask your doctor about the new vaccine.
Dr. [N|Henrik Aalto] published 14 papers.
You can text me at [P|(503) 555-0174] after six.
Fax [P|212-555-0163] or write.
My cell: [P|646-555-0129]
We stayed at the Grand Hotel in Vienna for 3 nights.
The Supreme Court ruled on Monday.
Microsoft Office costs 99.99 a year.
Mr. [N|Abernathy] opened the door.
Sincerely, [N|Martha Greene]
"I never saw it," said [N|Victor Hale].
The match between Real Madrid and Bayern Munich ended 2-1.
Chapter 7 describes the Roman Empire.
invoice 2023-004417 was paid
The phone has 12 buttons and a 5.5 inch display.
Number 10 Downing Street
She teaches physics at Stanford University.
[N|Ruth Abrams] joined Green Valley Farms in 2011.
Contact [N|Paul Desmond] at [P|020 7946 0123].
The call was 45 minutes long and cost 3.20.
Best wishes, [N|Caroline Frost]
Dear [N|Michael], the car is ready.
the cat sat on the mat near Oxford Street
His friend [N|Igor Malenko] lives in Prague.
Tel [P|+1 555 0100]
South Korea exports many ships.
Version 3.2.1 of Ubuntu Linux fixes 17 bugs.
Call Center Systems Ltd was founded in 1989.
The novel War and Peace has 1,225 pages.
We thank [N|Samuel Ortega] and [N|Dr. Lee] for comments.
passport [I|ZX0091827] expires in 2029
Today the Finance Ministry raised taxes by 2 percent.
serial number 88-1200-457 is on the back
[N|Thomas Brandt] said nothing.
Lufthansa Cargo flew 20 tons to Hanoi.
Reach us at [P|01865 496 011]!
The Doctor Who series began in 1963.
Jean sold 14 Blue Vases at the Christmas Market.
the neighbour, [N|Elena Rossi], called the police
My number is [P|773-555-0155].
The Social Democrats won 120 seats.
They travelled from Nairobi to Lake Victoria by bus.
[N|Andrew Finch] plays the cello.
Buy two Apple Pies today
Press the Red Button to start the Engine.
""".strip().split("\n")


def marked(sentence):
    """The text without its marks, and the spans that they name."""
    text, spans = "", []
    for part in re.split(r"(\[[NPI]\|[^\]]*\])", sentence):
        if re.match(r"\[[NPI]\|", part):
            spans.append((KIND[part[1]], len(text), len(text) + len(part) - 4))
            text += part[3:-1]
        else:
            text += part
    return text, spans


def found(text):
    base, spans = pii.find([text], pii.train())[0]
    return [(pii.KINDS[k], s, e) for s, k, e in spans if (s, k, e) not in base]


@pytest.mark.parametrize("sentence", EXAMPLES)
def test_examples(sentence):
    text, spans = marked(sentence)
    assert found(text) == spans


def test_the_field_learns_its_table():
    field, wrong, table = pii.train(), 0, sentences.labelled()
    for words, labels in table:
        emissions = np.array([field.emission(words, i) for i in range(len(words))])
        wrong += pii.viterbi(emissions[None], np.array([len(words)]), field.transitions)[0].tolist() != labels
    # In some patterns unlisted names and unlisted firms look the same.
    assert len(table) > 500 and wrong / len(table) < 0.1


def rates(rows):
    right, given, returned = Counter(), Counter(), Counter()
    for sentence in rows:
        text, spans = marked(sentence)
        own = found(text)
        given.update(k for k, _, _ in spans)
        returned.update(k for k, _, _ in own)
        right.update(k for k, _, _ in set(own) & set(spans))
    return {k: (right[k] / max(1, returned[k]), right[k] / max(1, given[k])) for k in KIND.values()}


def test_precision_and_recall_of_unseen_sentences():
    for kind, (precision, recall) in rates(UNSEEN).items():
        assert precision >= 0.7 and recall >= 0.7, (kind, precision, recall)


def test_remembered_scores_do_not_change_results(monkeypatch):
    text = " ".join(marked(s)[0] for s in UNSEEN)
    whole = found(text)
    monkeypatch.setattr(pii, "REMEMBERED", 3)
    pii.train().known.clear()
    assert found(text) == whole
