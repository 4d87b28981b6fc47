"""The continent rules: how a region label and a country name give a continent."""

from __future__ import annotations

from podium.functions.classify import Rule

# Country names in the spelling of the happiness tables.
AFRICA = (
    "Angola", "Algeria", "Benin", "Botswana", "Burkina Faso", "Burundi",
    "Cabo Verde", "Cameroon", "Central African Republic", "Chad", "Comoros",
    "Congo", "Djibouti", "Egypt", "Equatorial Guinea", "Eritrea", "Ethiopia",
    "Gabon", "Gambia", "Ghana", "Guinea", "Guinea-bissau", "Ivory Coast",
    "Kenya", "Lesotho", "Liberia", "Libya", "Madagascar", "Malawi", "Mali",
    "Mauritania", "Mauritius", "Morocco", "Mozambique", "Namibia", "Niger",
    "Nigeria", "Rwanda", "Sao Tome and Principe", "Senegal", "Seychelles",
    "Sierra Leone", "Somalia", "South Africa", "South Sudan", "Sudan",
    "Swaziland", "Tanzania", "Togo", "Tunisia", "Uganda", "Zambia", "Zimbabwe",
)
EUROPE = (
    "Albania", "Andorra", "Austria", "Belarus", "Belgium",
    "Bosnia and Herzegovina", "Bulgaria", "Croatia", "Cyprus",
    "Czech Republic", "Denmark", "Estonia", "Finland", "France", "Germany",
    "Greece", "Hungary", "Iceland", "Ireland", "Italy", "Kosovo", "Latvia",
    "Liechtenstein", "Lithuania", "Luxembourg", "Malta", "Moldova", "Monaco",
    "Montenegro", "Netherlands", "North Macedonia", "Norway", "Poland",
    "Portugal", "Romania", "San Marino", "Serbia", "Slovakia", "Slovenia",
    "Spain", "Sweden", "Switzerland", "Ukraine", "United Kingdom",
    "Vatican City", "Turkey",
)
# The same lists in the second spelling in use, where the words
# of an African name are joined by underscores and only first letters are
# capitals.
AFRICA_UNDERSCORED = (
    "Angola", "Algeria", "Benin", "Botswana", "Burkina_faso", "Burundi",
    "Cabo_verde", "Cameroon", "Central_african_republic", "Chad", "Comoros",
    "Democratic_republic_of_the_congo", "Republic_of_the_congo", "Djibouti",
    "Egypt", "Equatorial_guinea", "Eritrea", "Ethiopia", "Gabon", "Gambia",
    "Ghana", "Guinea", "Guinea-bissau", "Ivory_coast", "Kenya", "Lesotho",
    "Liberia", "Libya", "Madagascar", "Malawi", "Mali", "Mauritania",
    "Mauritius", "Morocco", "Mozambique", "Namibia", "Niger", "Nigeria",
    "Rwanda", "Sao_tome_and_principe", "Senegal", "Seychelles",
    "Sierra_leone", "Somalia", "South_africa", "South_sudan", "Sudan",
    "Swaziland", "Tanzania", "Togo", "Tunisia", "Uganda", "Zambia", "Zimbabwe",
)
EUROPE_SENTENCE_CASE = (
    "Albania", "Andorra", "Austria", "Belarus", "Belgium",
    "Bosnia and herzegovina", "Bulgaria", "Croatia", "Cyprus",
    "Czech republic", "Denmark", "Estonia", "Finland", "France", "Germany",
    "Greece", "Hungary", "Iceland", "Ireland", "Italy", "Kosovo", "Latvia",
    "Liechtenstein", "Lithuania", "Luxembourg", "Malta", "Moldova", "Monaco",
    "Montenegro", "Netherlands", "North macedonia", "Norway", "Poland",
    "Portugal", "Romania", "San marino", "Serbia", "Slovakia", "Slovenia",
    "Spain", "Sweden", "Switzerland", "Ukraine", "United kingdom",
    "Vatican city", "Turkey",
)


def continent_rules(
    africa: tuple[str, ...] = AFRICA, europe: tuple[str, ...] = EUROPE
) -> list[Rule]:
    """Rules for ``classify``. A country of an African region that is not in
    ``africa`` counts as Asian (the Middle East shares its label with North
    Africa), and so does a Commonwealth country that is not in ``europe``.
    """
    return [
        Rule("Oceania", members=("Australia", "New Zealand")),
        Rule("Europe", contains="Europe", members=europe, need="any"),
        Rule("Asia", contains="Asia"),
        Rule("America", contains="America"),
        Rule("Africa", contains="Africa", members=africa, need="all"),
        Rule("Asia", contains="Africa"),
        Rule("Asia", contains="Commonwealth"),
    ]
