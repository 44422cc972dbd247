"""Given names by gender and script, units, number words, and words around names: lists of our own for templates and surrogates."""

GIVEN = {
    ("f", "latin"): "Alice Anna Camila Carmen Charlotte Claire Emily Emma Greta Hannah Helen Ingrid Isabel Jane Julia Laura Linda Lucia Maria Mary Nancy Olivia Sarah Sofia Susan".split(),
    ("m", "latin"): "Adam Andreas Antonio Carlos Daniel David Edward Felix Henry Hugo James Jean Johannes John Jorge Louis Michael Paul Peter Robert Samuel Stefan Thomas Tom William".split(),
    ("f", "cyrillic"): "Анна Вера Екатерина Елена Ирина Мария Наталья Ольга Светлана Татьяна".split(),
    ("m", "cyrillic"): "Александр Алексей Андрей Борис Владимир Дмитрий Иван Михаил Николай Сергей".split(),
}
TITLES = {
    "m": "Mr Herr Señor Sr Monsieur Don".split(),
    "f": "Mrs Ms Miss Frau Señora Sra Madame Mme Doña".split(),
    "n": "Dr Prof".split(),
}
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles meter meters metre metres mg g kg gram grams kilogram kilograms ton tons tonne tonnes "
    "lb lbs pound pounds oz ounce ounces ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks "
    "month months year years percent dollar dollars euro euros cent cents degree degrees kmh mph"
).split()
NUMBER_WORDS = (
    "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty "
    "seventy eighty ninety hundred thousand million dozen"
).split()

#: Words, followed by a space, after which two or three capitalised words are a person. Each is of bounded length, for lookbehind.
INTRODUCES = [
    "[Mm]y name is", "name is", "I am", "I'm", "[Tt]his is", "called", "named", "[Dd]ear", "[Hh]ello", "[Hh]i", "signed by", "written by", "by", "with", "from", "contact",
    "[Cc]ontacted", "[Aa]sk", "asked", "told", "met", "[Mm]eet", "thank", "thanked", "[Tt]hanks to", "visited", "married", "hired", "employee", "patient", "customer", "colleague",
    "friend", "brother", "sister", "mother", "father", "daughter", "son", "wife", "husband", "author", "chairman", "director", "attorney",
    "[Ii]ch bin", "[Mm]ein Name ist", "[Ll]iebe", "[Ll]ieber", "heißt", "von", "mit", "[Jj]e suis", "m'appelle", "[Cc]her", "[Cc]hère", "avec", "[Mm]e llamo", "[Ss]oy", "[Qq]uerid[oa]", "con",
]
#: Words after two or three capitalised words that make them a person.
FOLLOWS = [
    *"said says wrote writes asked asks told tells replied replies answered explained explains lives lived works worked joined called calls signed bought sold".split(),
    *"who whose thinks thought agreed confirmed sagt sagte schrieb wohnt fragte antwortete dit écrit habite répondit dijo escribió vive preguntó respondió".split(), "was born",
]
LABELS = "Name Patient Customer Client Contact Author From To Attn Attention Employee Owner Sender Recipient Nombre Nom".split()
#: Capitalised words that are no part of a person's name.
NO_NAME = (
    "The This That These Those A An And Or But If In On At By For From With Of To It He She We You They I Is Are Was Were "
    "Monday Tuesday Wednesday Thursday Friday Saturday Sunday January February March April June July August September October November December "
    "License Licence Foundation University Inc Ltd Corp Company Institute Street Road Avenue Bank Council Ministry Department Software Public General Group "
    "United States Nations North South West East New San Los Saint Great River Lake Mount Island City County School College Church Museum Hotel Airport Station Park "
    "Air Royal National International Central Federal Apache Version Copyright English French German Spanish Russian Chinese European American British Der Die Das Und Le La Les El"
).split()
