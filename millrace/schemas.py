"""Record and message schemas, and the fixed value lists that results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# Members of the declared enumerations, in declaration order.
GLASSWARE = (
    "none rocks highball shotGlass coupe copperMug collins cocktailGlass wineGlass flute lowball fizz "
    "tikiMug pintGlass julepTin doubleRocks hurricane hollowedPineapple snifter scorpionBowl nickAndNora "
    "toddy pilsner sling goblet cantaritosClayPot martini"
).split()
UNITS = (
    "none ounces dashes tablespoon topoff item teaspoon toTaste barspoon cups splash discretion pinch"
).split()
PREPARATIONS = (
    "none chilled freshlySqueezed peeledAndJuiced freshlyGrated quartered freshPressed"
).split()
REQUIREMENTS = "none optional required".split()
APPLICATIONS = "base additional garnishment muddle".split()
TAXONOMY_GROUPS = (
    "none spirits liqueursAperitifsAndAmari wineBeerAndSake juicesAndPurees fruitsAndCitrus "
    "vegetablesAndSavoryProduce aromaticsTeaAndCoffee sweetenersAndSyrups savoryBrinyAndHeat bitters "
    "dairyAndEggs mixersSodaAndWater"
).split()
CATEGORIES = (
    "famous_references historical_and_geographical suggestions flavor_profile ingredients directions "
    "occasions variations other"
).split()
VISIBILITIES = "always holiday season".split()
COVERAGES = "all exact missing_1 missing_2 missing_3_plus".split()

ENUMS = {
    "glassware": GLASSWARE,
    "uoM": UNITS,
    "preparation": PREPARATIONS,
    "requirement": REQUIREMENTS,
    "applications": APPLICATIONS,
    "taxonomyFilterType": TAXONOMY_GROUPS,
}

KEYWORD_LISTS = (
    "keywordsBaseSpirit keywordsSpiritSubtype keywordsFlavorProfile keywordsCocktailFamily "
    "keywordsTechnique keywordsSeason keywordsOccasion keywordsMood keywordsSearchTerms"
).split()
KEYWORD_SCALARS = "keywordsStrength keywordsTemperature".split()

UNKNOWN_ID = "unknown"

STATES = tuple(f"{stage}-{end}" for stage in ("extraction", "chunking", "embedding") for end in ("succeeded", "failed"))

CHUNK = T.StructType([T.StructField("category", T.StringType()), T.StructField("content", T.StringType())])

IMAGE = "struct<type:string,uri:string,width:int,height:int>"
ITEM = (
    "struct<id:string,name:string,uoM:string,requirement:string,display:string,units:double,"
    "preparation:string,suggestions:string,types:array<string>,taxonomyFilterType:string,"
    "applications:array<string>>"
)
RATING = (
    "struct<oneStars:int,twoStars:int,threeStars:int,fourStars:int,fiveStars:int,totalStars:int,"
    "rating:double,ratingCount:int>"
)
KEYWORDS = (
    "struct<"
    + ",".join([f"{k}:array<string>" for k in KEYWORD_LISTS] + [f"{k}:string" for k in KEYWORD_SCALARS])
    + ">"
)
NUTRITION = (
    "struct<calories:double,servingVolumeMl:double,carbohydrateContent:double,sugarContent:double,"
    "fatContent:double,saturatedFatContent:double,proteinContent:double,fiberContent:double,"
    "sodiumContent:double,isEstimated:boolean,isComplete:boolean>"
)
DIETARY = (
    "struct<isVegan:boolean,isVegetarian:boolean,isDairyFree:boolean,isGlutenFree:boolean,"
    "isNutFree:boolean,isComplete:boolean>"
)

# field -> (Spark type, kind of JSON value it must hold); every one is required.
REQUIRED_FIELDS = {
    "id": ("string", "string"),
    "title": ("string", "string"),
    "descriptiveTitle": ("string", "string"),
    "description": ("string", "string"),
    "content": ("string", "string"),
    "publishedOn": ("timestamp", "instant"),
    "modifiedOn": ("timestamp", "instant"),
    "serves": ("int", "int"),
    "prepTimeMinutes": ("int", "int"),
    "isIba": ("boolean", "boolean"),
    "images": (f"array<{IMAGE}>", "array"),
    "glassware": ("array<string>", "array"),
    "rating": (RATING, "object"),
    "reactions": ("map<string,int>", "object"),
    "searchableTitles": ("array<string>", "array"),
    "tags": ("array<string>", "array"),
    "collections": ("array<string>", "array"),
    "hashtags": ("array<string>", "array"),
    "ingredients": (f"array<{ITEM}>", "array"),
    "instructions": ("array<struct<display:string,order:int>>", "array"),
    "keywords": (KEYWORDS, "object"),
    "recipeCuisine": ("string", "string"),
    "socialLinks": ("array<struct<type:string,url:string>>", "array"),
}
OPTIONAL_FIELDS = {"nutrition": (NUTRITION, "object"), "dietary": (DIETARY, "object")}

RECORD_DDL = ",".join(f"{name}:{spec[0]}" for name, spec in {**REQUIRED_FIELDS, **OPTIONAL_FIELDS}.items())
RECORD_STRUCT = f"struct<{RECORD_DDL}>"
RECORD_KEY = "record"  # the key of a published result's record, unless a stage is given another


def result_ddl(record_key: str, *fields: str) -> str:
    """Schema of a published result: the record under its key, and further fields."""
    name = record_key.replace("`", "``")
    return f"struct<{','.join([f'`{name}`:{RECORD_STRUCT}', *fields])}>"


MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField(
            "headers",
            T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])),
        ),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
