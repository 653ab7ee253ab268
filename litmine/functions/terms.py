"""RDF names.

Fixed values: these IRIs are the public vocabularies the output is written in.
"""

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XSD = "http://www.w3.org/2001/XMLSchema#"
DCT = "http://purl.org/dc/terms/"
FOAF = "http://xmlns.com/foaf/0.1/"
FABIO = "http://purl.org/spar/fabio/"
FRBR = "http://purl.org/vocab/frbr/core#"
PRISM = "http://prismstandard.org/namespaces/basic/3.0/"

RDF_TYPE = RDF + "type"
RDF_FIRST = RDF + "first"
RDF_REST = RDF + "rest"
RDF_NIL = RDF + "nil"

DCT_TITLE = DCT + "title"
DCT_CREATOR = DCT + "creator"
DCT_ISSUED = DCT + "issued"
DCT_MODIFIED = DCT + "modified"
DCT_CITATION = DCT + "bibliographicCitation"
DCT_REFERENCES = DCT + "references"

ARTICLE_CLASS = FABIO + "Article"
JOURNAL_CLASS = FABIO + "Journal"
VOLUME_CLASS = FABIO + "JournalVolume"
ISSUE_CLASS = FABIO + "JournalIssue"
AGENT_CLASS = FOAF + "Agent"

PUBLICATION_YEAR = FABIO + "hasPublicationYear"
JOURNAL_ABBREVIATION = FABIO + "hasNLMJournalTitleAbbreviation"
PART_OF = FRBR + "partOf"
DOI = PRISM + "doi"
STARTING_PAGE = PRISM + "startingPage"
ENDING_PAGE = PRISM + "endingPage"
PAGE_RANGE = PRISM + "pageRange"
ISSN = PRISM + "issn"
E_ISSN = PRISM + "eIssn"
VOLUME = PRISM + "volume"
ISSUE_IDENTIFIER = PRISM + "issueIdentifier"
NAME = FOAF + "name"
FAMILY_NAME = FOAF + "familyName"
GIVEN_NAME = FOAF + "givenName"

XSD_STRING = XSD + "string"
LANGUAGE_PREFIX = RDF + "langString@"
XSD_INTEGER = XSD + "integer"
XSD_DATE = XSD + "date"
XSD_GYEAR = XSD + "gYear"
XSD_GYEARMONTH = XSD + "gYearMonth"
XSD_DURATION = XSD + "duration"

ARTICLE_COUNT = "http://example.org/pubMedArticleCount"
TRIPLE_COUNT = "http://example.org/triplesGenerated"
TIME_TAKEN = "http://example.org/timeTakenToProcess"
