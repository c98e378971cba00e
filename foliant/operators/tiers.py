"""Relevance tiers of subjects: the taxonomy patch, the seeding, the report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import new_ids

#: Vocabulary, subject type, tier, weight, terms; in the order in which they are seeded.
TIERS = (
    ("Scopus", "SubjectArea", "A", 10.0, ("Anthropology",)),
    ("Scopus", "SubjectArea", "S", 6.0, ("Sociology and Political Science",)),
    ("Scopus", "SubjectArea", "B", 8.0, (
        "Cultural Studies", "History", "Gender Studies", "Demography", "Political Science and International Relations", "Archeology", "Archeology (arts and humanities",
    )),
    ("Scopus", "SubjectArea", "C", 5.0, (
        "Education", "Literature and Literary Theory", "Law", "Religious Studies", "Communication", "Philosophy", "Geography, Planning and Development",
        "Linguistics and Language", "Language and Linguistics", "Visual Arts and Performing Arts", "Urban Studies", "Social Sciences (miscellaneous)",
        "Social Sciences (all", "Public Administration", "Development", "Arts and Humanities (miscellaneous)", "Arts and Humanities (all", "Music",
        "Classics", "Museology", "Industrial Relations",
    )),
    ("Scopus", "SubjectArea", "D", 2.0, (
        "Economics and Econometrics", "Psychiatry and Mental Health", "Social Psychology", "Clinical Psychology", "Applied Psychology",
        "Developmental and Educational Psychology", "Experimental and Cognitive Psychology", "Psychology (all", "Psychology (miscellaneous)",
        "Health (social science", "Health Policy", "History and Philosophy of Science", "Library and Information Sciences", "Architecture",
        "Tourism, Leisure and Hospitality Management", "Media Technology", "Public Health, Environmental and Occupational Health",
        "Life-span and Life-course Studies", "Geriatrics and Gerontology", "Human Factors and Ergonomics", "Cognitive Neuroscience",
    )),
    ("Scopus", "SubjectArea", "E", 0.5, ("Multidisciplinary",)),
    ("Scopus", "SubjectArea", "N", 5.0, ("Paleontology",)),
    ("Scopus", "SubjectArea", "N", 3.0, (
        "Anatomy", "Genetics", "Animal Science and Zoology", "Pathology and Forensic Medicine", "Developmental Biology", "Ecology",
    )),
    ("Scopus", "SubjectArea", "N", 2.0, ("Ecology, Evolution, Behavior and Systematics",)),
    ("OpenAlex", "Subfield", "A", 10.0, ("Anthropology",)),
    ("OpenAlex", "Subfield", "S", 6.0, ("Sociology and Political Science",)),
    ("OpenAlex", "Subfield", "B", 8.0, ("Political Science and International Relations", "Archeology")),
    ("OpenAlex", "Subfield", "C", 5.0, (
        "Literature and Literary Theory", "Linguistics and Language", "Geography, Planning and Development", "Visual Arts and Performing Arts",
        "Education", "Development",
    )),
    ("OpenAlex", "Subfield", "D", 2.0, (
        "Economics and Econometrics", "Developmental and Educational Psychology", "Experimental and Cognitive Psychology",
        "Psychiatry and Mental health", "Public Health, Environmental and Occupational Health", "Ecology, Evolution, Behavior and Systematics",
        "Complementary and alternative medicine", "Speech and Hearing",
    )),
    ("OpenAlex", "Topic", "N", 1.5, (
        "Forensic Anthropology and Bioarchaeology Studies", "Paleopathology and ancient diseases", "Primate Behavior and Ecology",
    )),
    ("OpenAlex", "Topic", "N", 1.0, (
        "Pleistocene-Era Hominins and Archaeology", "Evolution and Paleontology Studies", "Paleontology and Evolutionary Biology",
    )),
)
#: Topics without a parent that belong to the subfield that the patch adds.
PATCHED = ("Anthropological Studies and Insights", "Anthropology: Ethics, History, Culture", "European Linguistics and Anthropology")
SUBFIELD = ("Anthropology", "OpenAlex", "Subfield", "anthropology")


def patch_taxonomy(subjects: DataFrame) -> DataFrame:
    """The subfield is added unless there, and its topics that have no parent get it as theirs."""
    spark = subjects.sparkSession
    own = (F.col("vocabulary") == SUBFIELD[1]) & (F.col("subject_type") == SUBFIELD[2]) & (F.lower(F.rtrim("term")) == SUBFIELD[0].lower())
    missing = subjects.where(own).agg(F.count(F.lit(1)).alias("n"))
    row = spark.createDataFrame([SUBFIELD], "term string, vocabulary string, subject_type string, term_key string").where(missing.scalar() == 0)
    made = new_ids(subjects, "id", row, "term_key")
    everything = subjects.unionByName(made, allowMissingColumns=True)
    parent = everything.where(own).agg(F.min("id").alias("id"))
    topic = (F.col("vocabulary") == "OpenAlex") & (F.col("subject_type") == "Topic") & F.lower(F.rtrim("term")).isin(*[t.lower() for t in PATCHED])
    patched = everything.withColumn("parent_id", F.when(topic & F.col("parent_id").isNull(), parent.scalar()).otherwise(F.col("parent_id")))
    return patched.select(*subjects.columns)


def seed(subjects: DataFrame) -> DataFrame:
    """subject_id, vocabulary, tier, weight of every listed subject; case and trailing blanks of terms don't matter.

    The rules are a literal table of fixed size, so they are broadcast.
    """
    rules = [(v, k, t, w, term.lower()) for v, k, t, w, terms in TIERS for term in terms]
    table = subjects.sparkSession.createDataFrame(rules, "vocabulary string, subject_type string, tier string, weight double, term string")
    rows = subjects.select(F.col("id").alias("subject_id"), "vocabulary", "subject_type", F.lower(F.rtrim("term")).alias("term"))
    return rows.join(F.broadcast(table), ["vocabulary", "subject_type", "term"]).select("subject_id", "vocabulary", "tier", F.col("weight").cast("decimal(5,2)").alias("weight"))


def report(tiers: DataFrame) -> DataFrame:
    """How many subjects each vocabulary, tier and weight has."""
    return tiers.groupBy("vocabulary", "tier", "weight").agg(F.count(F.lit(1)).alias("subjects")).orderBy("vocabulary", "tier", "weight")
