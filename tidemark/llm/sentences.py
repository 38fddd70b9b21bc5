"""The labelled table of the random field for personal data: invented sentences.

Sentences are patterns whose slots are filled from the lists below, each pattern FILLINGS
times with other fillers, by a fixed rule. Fillers of NAME, PHONE and ID carry that label,
all others none, so that places, firms and products stand where names do.
"""

from __future__ import annotations

import re

# Common given names, a feature of words.
GIVEN = frozenset(
    """adam alan albert alex alice amanda amy andrea andrew angela anna anne anthony antonio barbara ben betty bob
    brian carl carlos carol caroline catherine charles charlotte chris christina daniel david deborah diana diego
    donald dorothy edward elena elizabeth ellen emily emma eric erik eva frank fred george grace hannah hans harold
    heather helen henry isabel jack jacob james jan jane janet jason javier jean jennifer jeremy jessica jim joan joe
    john jonathan jorge jose joseph joshua juan judith julia julie karen karl kate katherine kevin laura linda lisa
    lucas lucy luis manuel margaret maria marie mark marta martha martin mary matthew michael michelle miguel monica
    nancy nicole olivia oscar pablo patricia patrick paul paula pedro peter philip rachel ralph raymond rebecca
    richard robert roger rosa rose ruth sally samuel sandra sara sarah scott sharon sofia sophie stefan stephen steve
    susan teresa theresa thomas tim tom victor walter wendy william""".split()
)
# Words that names of places, firms, products, works and laws are made with.
THING = frozenset(
    """act agency airlines airport alps april association august avenue bank bay bible board book boulevard bridge
    building bureau canal castle cathedral central centre center chapter church city club coast college commission
    committee common commons company congress corporation council country county court cross december deep department
    desert district east eastern edition empire estate europe factory february federal festival figure forest forum
    foundation free friday fund gallery garden gardens general golden government grand great group guide gulf hall
    harbour high hill hills hospital hotel house inc institute international island islands january july june king
    lake language learning library licence license limited los ltd machine magazine march market may memorial ministry
    monday mount mountain mountains museum national new news north northern november ocean october office old open
    opera orchestra organization palace park parliament party peninsula persian phone pro project protocol province
    public queen radio railway red republic research river road royal saint san santa school sea section security
    senate september server services show social society software south southern square standard state states station
    store street summit sunday systems table team telecom theatre thursday times tower town treaty tuesday union
    united university valley version village war wednesday west western windows world""".split()
)

_NAMES = (
    "Alice Hammond;Bruno Castellano;Peter Novak;Ingrid Solberg;Maria Delgado;Tobias Renner;Sarah Whitcombe;"
    "Yusuf Demir;John Harper;Akiko Tanaka;Karl Lindqvist;Priya Nair;David Okonkwo;Zofia Wrona;Emma Blackwood;"
    "Rafael Quintana;Thomas J. Eddington;Leopold Marsh;Anna-Lena Vogt;Kwame Mensah;Helen O'Connor;Dmitri Sokolov;"
    "Robert Ashdown;Noor Rahman;Julia Mary Pemberton;Fergus Calloway;Susan Trevino;Wei Zhang"
).split(";")
_FAMILIES = "Hammond;Castellano;Novak;Whitcombe;Demir;Okonkwo;Lindqvist;Pemberton;Trevino;Sokolov;Ashdown".split(";")
_PLACES = (
    "Lisbon;New Haven;Mount Kenya;Kyoto;North Carolina;San Marino;Buenos Aires;Lake Geneva;Warsaw;Abbey Road;Toronto;"
    "Central Station;Red Square;Norway;Kensington Gardens;Los Alamos;Cape Town;Victoria Street;Hong Kong;Berlin;Cairo;Puerto Rico;"
    "Helsinki;Sierra Leone;Great Yarmouth;Monte Carlo;Rocky Mountains;Sri Lanka;Costa Rica;Addis Ababa;Baden Baden;Black Sea"
).split(";")
_FIRMS = (
    "Northwind Traders;Acme Corporation;Blue Lantern;Siemens;Royal Mail;General Motors;Orion Software;World Bank;"
    "Green Cross;Amazon;Deutsche Telekom;Harbour Foods Ltd;National Theatre;Toyota;United Airlines;Oxfam;"
    "Volvo Trucks;Banco Azul;Air France;Burger Palace;Dow Jones;Hudson Labs;Tata Steel;Manchester City;Inter Milan;"
    "Boston Celtics;Human Rights Watch"
).split(";")
_PRODUCTS = (
    "Adobe Reader;Machine Learning;Street View;Windows Server;Open Office;Visual Studio;Galaxy Tab;Deep Space;"
    "Java;Python;Red Hat Linux;Final Fantasy;Common Law;Pocket Guide;Star Atlas;Model Three;"
    "Moby Dick;Great Expectations;Swan Lake;Jurassic Park;Organic Chemistry;Data Mining;Modern Art;Little Women;"
    "Quantum Mechanics;Income Tax;Prime Minister;Chief Executive;Civil Engineering"
).split(";")
_PHONES = (
    "(415) 555-0132;415-555-0187;020 7946 0958;(212) 555 0199;0171 555 0123;303.555.0144;555-0166;01632 960 983;"
    "617-555-0145;07700 900 461;(303) 555-0111;07911 123456;555 0148;0161 4960 771;718-555-0102"
).split(";")
_IDS = "078-05-1120;219-09-9999;457-55-5462;123-45-6789;912-84-7710;321-54-9876;601-22-3345".split(";")
_PASSPORTS = "533380006;C01X00T47;912803456;K7719023;L8898902;AB1234567;P44120987;220145873;E00009871".split(";")
_NUMBERS = "12;300;4,512;25.99;1998;2021-04-05;40021;6.1;118;2,000,000;3.5;1984;87;10:15;2003;045-220;555".split(";")
_THINGS = "Blue Lanterns;Great Pumpkins;Small Boats;Red Foxes;Old Masters;Wooden Chairs;Fast Trains;Paper Cranes".split(";")
# Numbers in the forms of phones and ids that are neither.
_CODES = "555-0144;078-05-1121;4417-8821;330-22-1098;555-0199;X4410927;017 4415;(212) 4400;90-331-2207".split(";")
SLOTS = {
    "NAME": _NAMES, "FAMILY": _FAMILIES, "PLACE": _PLACES, "FIRM": _FIRMS, "PRODUCT": _PRODUCTS,
    "PHONE": _PHONES, "SSN": _IDS, "PASSPORT": _PASSPORTS, "NUMBER": _NUMBERS,
    "THINGS": _THINGS, "CODE": _CODES,
}
LABEL = {"NAME": 1, "FAMILY": 1, "PHONE": 2, "SSN": 3, "PASSPORT": 3}

# Patterns; marks may stand around a slot.
PATTERNS = """
Mr. FAMILY signed the lease on Monday .
Mrs NAME will attend the meeting in PLACE
Dr. NAME reviewed the chart , and Dr. FAMILY agreed .
Ms. FAMILY arrived late
The board thanked Prof. NAME for the talk at FIRM .
we met NAME at noon near PLACE
I met NAME and NAME at the station .
a letter from NAME came with a note from FIRM
signed by NAME in NUMBER
Signed , NAME
Name: NAME
Name: NAME , Phone: PHONE
my name is NAME and I live in PLACE .
Her name was NAME .
my friend NAME said so
NAME visited PLACE .
NAME spoke in PLACE on Monday .
NAME said that FIRM would close .
NAME wrote to FIRM about PRODUCT .
Yesterday NAME told the court he was ill .
According to NAME , the price of PRODUCT rose to NUMBER .
" It is late , " said NAME .
" We sold PRODUCT , " NAME told reporters in PLACE .
ask NAME about it
Please contact NAME on PHONE or at FIRM .
Contact: NAME , PHONE
The patient , NAME , was born in NUMBER .
The teacher NAME lives in PLACE with her son NAME .
Best regards , NAME
Yours sincerely , NAME
Dear NAME , thank you for the order NUMBER .
Dear Mr. FAMILY , we have your letter .
written by NAME and edited by NAME
He married NAME in NUMBER .
NAME joined FIRM in NUMBER .
the neighbour NAME owns a house in PLACE
NAME , NUMBER , of PLACE
we gave the keys to NAME yesterday
he plays with NAME on Sunday
the author NAME was here
She called NAME and left .
Please call PHONE before noon .
You can phone me at PHONE any time
Tel: PHONE or write to us
Tel. PHONE
Telephone PHONE is the front desk of FIRM
mobile PHONE , evenings only
Fax: PHONE for orders
Call PHONE and ask for the manager
call me on PHONE !
my phone is PHONE at home
phone number: PHONE , thank you
my number is PHONE , text me
Reach me on PHONE
you may reach her at PHONE until NUMBER
dial PHONE for help with PRODUCT
ring us on ( PHONE )
Her cell was PHONE .
phone him tomorrow morning on PHONE ?
His SSN is SSN as on file
SSN: SSN
SSN# SSN
SSN (SSN)
social security number SSN was entered
The ssn SSN belongs to the tenant
Her ssn , we were told , is SSN !
Social Security No. SSN of NAME
her social security number as shown on file was SSN
passport PASSPORT was issued in May
passport no. PASSPORT expired in NUMBER
her passport number is PASSPORT .
passport (PASSPORT) was given to NAME
The passport she had with her had number PASSPORT in it
Passport: PASSPORT
travels on passport PASSPORT
The Mayor of PLACE met the Board of FIRM .
we met in PLACE on Monday and on Tuesday
we met at FIRM in NUMBER
a letter from FIRM came in May
a letter from PLACE
signed by FIRM in NUMBER
made by FIRM in PLACE
by FIRM
PLACE is a town of NUMBER people .
PLACE was cold .
FIRM said that sales of PRODUCT fell .
FIRM sells PRODUCT in PLACE .
FIRM opened an office in PLACE .
" We are open , " said FIRM .
the train to PLACE leaves at NUMBER
they went from PLACE to PLACE
ask FIRM about PRODUCT
PRODUCT is new in version NUMBER .
we use PRODUCT with PRODUCT at work
he plays PRODUCT on Sunday
She read PRODUCT and left .
the software PRODUCT by FIRM
he works for FIRM in PLACE
Download PRODUCT from FIRM today
The Chapter on PRODUCT begins on page NUMBER .
The order NUMBER was shipped on NUMBER to PLACE
It costs NUMBER and weighs NUMBER g
The call took NUMBER ms
The call took CODE ms
a call of CODE ms
the text takes CODE ms
the text has CODE words
the phone weighs CODE grams
CODE rows came in NUMBER
Yesterday CODE parts were sold in PLACE
room CODE is on floor NUMBER
part CODE of machine CODE costs NUMBER euros
build CODE of PRODUCT failed
In NUMBER the NUMBER THINGS cost NUMBER
with NUMBER THINGS on the wall
THINGS are sold at FIRM
the THINGS were old
PRODUCT shows the way to PLACE
FIRM PRODUCT shows the news
we saw the PLACE and PLACE
PRODUCT is hard
FIRM beat FIRM NUMBER to NUMBER
FIRM bought land in PLACE .
FIRM lost NUMBER contracts .
the PRODUCT said that PLACE was safe
the PRODUCT of PLACE spoke in PLACE
the PLACE grows tea
we studied PRODUCT at FIRM with the FIRM team
Open the PRODUCT and close the PRODUCT
All PRODUCT classes begin at NUMBER
The PRODUCT , the FIRM and the PLACE
The call lasted NUMBER minutes
call NUMBER of them back in NUMBER
We call this step NUMBER of NUMBER
The phone costs NUMBER euros at FIRM
a phone with NUMBER GB and a NUMBER inch screen
the mobile market grew NUMBER percent
the passport office opens at NUMBER
the number NUMBER appears twice
number NUMBER in the list
item CODE costs NUMBER
item CODE in box NUMBER
serial 978-3-16-148410-0 in the list
Flight NUMBER left PLACE from gate NUMBER
see page NUMBER , lines 20-35 , of volume NUMBER
In NUMBER there were NUMBER members
10.0.0.1 answered in NUMBER ms
2024-01-31 10:15:00 started
code 4111 1111 1111 1112 was refused
social events in NUMBER and NUMBER
tables of the security team hold NUMBER rows
The end came . And so on . Then they left . Some of it was lost .
It was fine. The end. But We Know. And. Of The Rest
Terms And Conditions Apply
How To Cook Rice In NUMBER Minutes
Breaking News From PLACE
All Rights Reserved . Printed In PLACE
Published under the Open Public License , version NUMBER .
Der Mann und die Frau gehen in die Stadt . Das Haus ist alt .
Die Zeit der Arbeit ist vorbei , sagte der Lehrer dem Kind .
El perro y la casa . La mesa de El Rey . Los Libros son viejos .
Le chat et la maison . La table du Roi . Les Enfants jouent .
Lorem ipsum dolor Sit amet . Consectetur adipiscing Elit
Sit Amet Elit Dolor magna Aliqua
zorp Blenk fonn the Drabbit . Mumble grost
Wibble Wobble the end . Plonk! Grunt? Zap!
PLONK AND ZAP IN CAPITALS
Dr. is short for doctor
Mr. and Mrs. are titles
""".strip().split("\n")
FILLINGS = 6

_SLOT = re.compile("|".join(sorted(SLOTS, key=len, reverse=True)))


def labelled() -> list[tuple[list[str], list[int]]]:
    """Words and labels of each sentence."""
    table = []
    used = dict.fromkeys(SLOTS, 0)
    for pattern in PATTERNS:
        for _ in range(FILLINGS if _SLOT.search(pattern) else 1):
            words, labels = [], []
            for part in pattern.split():
                slot = _SLOT.search(part)
                if slot is None:
                    own = [part]
                else:
                    fillers = SLOTS[slot[0]]
                    # Each slot goes through its list, whatever the pattern.
                    filler = fillers[used[slot[0]] % len(fillers)]
                    used[slot[0]] += 1
                    own = (part[: slot.start()] + filler + part[slot.end() :]).split()
                words += own
                labels += [LABEL.get(slot[0], 0) if slot else 0] * len(own)
            table.append((words, labels))
    return table
