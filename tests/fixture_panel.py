"""The invented panel of FIXTURES.md section 3, as CSV text."""

SNAPSHOT = """\
Country name,Regional indicator,Ladder score,Logged GDP per capita,Healthy life expectancy
Finland,Western Europe,7.8,10.8,72.0
Norway,Western Europe,7.4,11.1,73.0
New Zealand,North America and ANZ,7.3,10.6,73.4
Canada,North America and ANZ,7.1,10.8,73.8
Israel,Middle East and North Africa,7.2,10.6,73.5
Egypt,Middle East and North Africa,4.3,9.4,62.0
South Africa,Sub-Saharan Africa,4.9,9.4,56.9
Japan,East Asia,5.9,10.6,75.1
Ukraine,Commonwealth of Independent States,4.9,9.4,64.9
Kazakhstan,Commonwealth of Independent States,6.2,10.2,65.2
Atlantis,Unknown,,,
"""

HISTORY = """\
Country name,year,Life Ladder,Log GDP per capita,Healthy life expectancy at birth
Japan,2016,6.0,10.5,74.0
Luxland,2018,,11.2,60.0
Finland,2019,7.8,10.7,71.9
Norway,2019,7.5,11.0,73.2
Japan,2019,5.9,10.6,75.0
Israel,2019,7.1,10.6,
Luxland,2019,5.0,11.3,76.0
Finland,2020,7.9,10.75,72.1
Norway,2020,7.9,11.05,73.1
Japan,2020,6.1,10.6,75.2
Luxland,2020,,11.4,
"""
