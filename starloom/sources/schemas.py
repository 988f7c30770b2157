"""Declared schemas of the four raw inputs, as DDL."""

# Column names, types and order in the raw files.
IMMIGRATION = (
    "cicid double, i94yr double, i94mon double, i94cit double, i94res double, "
    "i94port string, arrdate double, i94mode double, i94addr string, depdate double, "
    "i94bir double, i94visa double, count double, dtadfile string, visapost string, "
    "occup string, entdepa string, entdepd string, entdepu string, matflag string, "
    "biryear double, dtaddto string, gender string, insnum string, airline string, "
    "admnum double, fltno string, visatype string"
)
TEMPERATURE = (
    "dt date, AverageTemperature double, AverageTemperatureUncertainty double, "
    "City string, Country string, Latitude string, Longitude string"
)
DEMOGRAPHICS = (
    "City string, State string, `Median Age` double, `Male Population` int, "
    "`Female Population` int, `Total Population` int, `Number of Veterans` int, "
    "`Foreign-born` int, `Average Household Size` double, `State Code` string, "
    "Race string, Count int"
)
COUNTRY_CODES = "code int, Name string"
