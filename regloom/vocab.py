"""Fixed values.

Everything in this module is a constant the results depend on: vocabularies,
ordered rule lists, patterns and limits of the certificate domain. Order inside
a list is the precedence of its rules.
"""

# --- Fixed values: organism labels and their folded aliases ------------------
ORGANISM_ALIASES = [
    ("Yeasts and moulds", ["yeastsandmoulds", "yeastsandmolds", "yeastmould", "yeastmold",
                           "levuresetmoisissures", "levuresmoisissures"]),
    ("Total viable count (aerobic mesophilic flora)", [
        "totalviablecount", "totalbacterialcount", "aerobicmesophilicflorattotalviablecount",
        "aerobicmesophilicfloratotalviablecount", "floretotale", "totalplatecount",
        "totalaerobiccount"]),
    ("Escherichia coli O157", ["ecolio157", "escherichiacolio157", "ecolio157h7",
                               "escherichiacolio157h7"]),
    ("Shiga toxin-producing E. coli (STEC)", [
        "shigatoxinproducingecolistec", "stecshigatoxinproducingescherichiacoli", "stec", "ehec",
        "shigatoxinproducingescherichiacoli"]),
    ("Escherichia coli", ["escherichiacoli", "ecoli"]),
    ("Listeria spp. and L. monocytogenes", [
        "listeriasppandlmonocytogenes", "listeriamonocytogeneslisteriaspp",
        "listeriasppandlisteriamonocytogenes", "listeriamonocytogenesandlisteriaspp"]),
    ("Escherichia coli and coliforms", ["escherichiacolicoliforms", "escherichiacoliandcoliforms"]),
    ("Enterobacteriaceae and Cronobacter spp.", ["enterobacteriaceaecronobacterspp",
                                                 "enterobacteriaceaeandcronobacterspp"]),
    ("Salmonella spp. and Enterobacteriaceae", ["salmonellasppenterobacteriaceae",
                                                "salmonellasppandenterobacteriaceae"]),
    ("Mesophilic lactic acid bacteria", ["bacterieslactiquesmesophiles",
                                         "mesophiliclacticacidbacteria", "lacticacidbacteria"]),
    ("Coagulase-positive staphylococci", ["coagulasepositivestaphylococci", "staphylococcusaureus",
                                          "coagulasepositivestaphylococcus"]),
    ("Enterobacteriaceae", ["enterobacteriaceae", "enterobacterales"]),
    ("Somatic cell count", ["somaticcellcount", "somaticcells"]),
    ("Salmonella spp.", ["salmonellaspp", "salmonella"]),
    ("Listeria monocytogenes", ["listeriamonocytogenes", "lmonocytogenes"]),
    ("Listeria spp.", ["listeriaspp", "listeria"]),
    ("Cronobacter spp.", ["cronobacterspp", "cronobacter", "enterobactersakazakii"]),
    ("Campylobacter spp.", ["campylobacterspp", "campylobacter"]),
    ("Bacillus cereus", ["bacilluscereus", "bacilluscereusgroup"]),
    ("Pseudomonas spp.", ["pseudomonasspp", "pseudomonas"]),
    ("Enterococcus spp.", ["enterococcusspp", "enterococcus"]),
    ("Coliforms", ["coliforms", "coliformes", "gasproducingcoliforms"]),
    ("Antibiotic residues", ["antibioticresidues", "residusdantibiotiques"]),
    ("Commercial sterility", ["commercialsterility", "sterilitecommerciale"]),
]

# --- Fixed values: manufacturer labels and folded substrings, first match wins
MANUFACTURER_PATTERNS = [
    ("bioMérieux", ["biomerieux"]),
    ("Bio-Rad", ["biorad"]),
    ("Neogen", ["neogen"]),
    ("Hygiena", ["hygiena"]),
    ("MilliporeSigma (Merck)", ["milliporesigma", "millaporesigma", "millipore"]),
    ("Solabia", ["solabia"]),
    ("Solus Scientific (PerkinElmer)", ["solusscientific"]),
    ("Thermo Fisher Scientific", ["thermofisher", "thermoscientific", "oxoid", "lifetechnologies",
                                  "termofisher"]),
    ("Foss", ["fossanalytical", "foss"]),
    ("Bruker", ["bruker"]),
    ("Shimadzu Diagnostics", ["shimadzu"]),
    ("Kikkoman Biochemifa", ["kikkoman"]),
    ("JNC Corporation", ["jnccorporation"]),
    ("Gold Standard Diagnostics", ["goldstandarddiagnostics"]),
    ("Bentley Instruments", ["bentleyinstruments"]),
    ("CONGEN Biotechnologie", ["congen"]),
    ("R-Biopharm", ["rbiopharm"]),
    ("Charm Sciences", ["charmsciences"]),
    ("Check-Points", ["checkpoints"]),
    ("BioChek", ["biochek"]),
    ("Delta Instruments", ["deltainstruments"]),
    ("IDEXX", ["idexx"]),
    ("SY-LAB", ["sylab"]),
    ("HyServe", ["hyserve"]),
    ("DSM", ["dsmfood", "dsm"]),
    ("Autobio Diagnostics", ["autobio"]),
    ("Applied Food Diagnostics", ["appliedfooddiagnostics"]),
    ("ALS Life Sciences", ["alslifesciences"]),
    ("MCS Diagnostics", ["mcsdiagnostics"]),
    ("Microbial Systems", ["microbialsystems"]),
    ("SAN Group Biotech", ["sangroup"]),
]

# --- Fixed values: expert laboratories, first match wins ---------------------
EXPERT_LAB_PATTERNS = [
    ("ADRIA Développement", ["adria"]),
    ("Microsept", ["microsept"]),
    ("ISHA", ["isha", "institutscientifiquedhygieneetdanalyse"]),
    ("Institut Pasteur de Lille", ["institutpasteurdelille", "iplsante", "ipl"]),
    ("ACTALIA", ["actalia"]),
    ("Inovalys", ["inovalys"]),
    ("Labocea", ["labocea", "lda22"]),
    ("Eurofins", ["eurofins"]),
    ("CTCPA", ["ctcpa"]),
    ("Campden BRI", ["campdenbri", "campden"]),
    ("NIZO", ["nizo"]),
    ("TNO", ["tno"]),
    ("Q-lip", ["qlip"]),
    ("Wageningen Food Safety Research", ["wageningen", "rikilt"]),
    ("Fraunhofer IVV", ["fraunhofer"]),
    ("SGS", ["sgs"]),
    ("LRQA Nederland", ["lrqa"]),
]
LAB_STOPWORDS = [
    "for", "the", "this", "these", "all", "both", "each", "one", "two", "a", "an", "and", "or",
    "of", "in", "on", "by", "with", "le", "la", "les", "un", "une", "des", "du", "de", "et",
    "par", "study", "etude", "report", "method", "test", "sample", "samples", "laboratory",
    "laboratoire", "expert",
]
PERSON_NAME = r"^\s*(?:[A-Z]\.\s*){1,3}[A-Z][\w'\-]+\s*$"
# Laboratory names printed in report headers, in order of trust.
KNOWN_LAB_TOKENS = [
    "ADRIA", "Microsept", "ISHA", "Institut Pasteur de Lille", "IPL Sant", "ACTALIA", "Labocea",
    "LDA 22", "Eurofins", "CTCPA", "Campden BRI", "NIZO", "TNO", "Q-lip", "Qlip", "Wageningen",
    "RIKILT", "Fraunhofer", "SGS",
]
LAB_SENTENCES = [
    r"[Ee]xpert\s+laboratory\s*:?\s*([A-Z][\w'\-À-ſ&. ]{2,60})",
    r"[Ll]aboratoire\s+expert\s*:?\s*([A-Z][\w'\-À-ſ&. ]{2,60})",
    r"[Ss]tudy\s+(?:was\s+)?(?:carried\s+out|performed|conducted)\s+by\s+(?:the\s+)?"
    r"([A-Z][\w'\-À-ſ&. ]{2,60})",
    r"[Ee]tude\s+r[ée]alis[ée]e\s+par\s*:?\s*([A-Z][\w'\-À-ſ&. ]{2,60})",
]
LAB_CAPTURE_TAIL = (
    r"(?is)\s+(?:in|at|on|for|and|with|from|according|located|based|situated|"
    r"en|au|aux|dans|selon|pour|et|sur)\b.*$|[.;,].*$"
)
OPENING_PAGES = 6

# --- Fixed values: detection technology --------------------------------------
TECHNOLOGY_LABELS = {
    "culture_media": "Culture media",
    "molecular_pcr": "Molecular (PCR / hybridisation)",
    "immunological_elisa": "Immunological / ELISA",
    "flow_cytometry": "Flow cytometry",
    "biochemical": "Biochemical",
    "inhibition_assay": "Microbial inhibition",
    "other": "Other",
}
TECHNOLOGY_ALIASES = {"chromogenic_agar": "culture_media"}
# Product-name keywords, first technology wins.
PRODUCT_TECHNOLOGY = [
    ("molecular_pcr", ["foodproof", "food proof", "vetproof", "vet proof", "gene-up", "geneup",
                       "surefast", "kylt", "iq-check", "iqcheck", "inviscreen", "bax",
                       "assurance gds", "check & trace", "check and trace",
                       "molecular detection assay", "mda 2", "mda2", "3plex", "taqman",
                       "real-time pcr", "realtime pcr", " pcr"]),
    ("flow_cytometry", ["fossomatic", "bacsomatic", "bactoscan", "bactocount", "somascope",
                        "d-count", "d‐count", "dcount", "somacount"]),
    ("culture_media", ["simplate", "chromid", "precis", "petrifilm", "compact dry", "easy plate",
                       "mc-media", "peelplate", "one plate", "rida count", "certablue", "agar",
                       "plate count"]),
    ("immunological_elisa", ["elisa", "vidas", "transia", "singlepath", "duopath", "rapidchek",
                             "lateral flow", "immunoassay"]),
    ("biochemical", ["api ", "vitek", "tempo", "soleris", "malthus", "bactometer"]),
]
# Report-text evidence, first technology with two distinct keywords wins.
TEXT_TECHNOLOGY = [
    ("inhibition_assay", ["stearothermophilus", "growth inhibition", "inhibition de la croissance",
                          "ph indicator", "indicateur de ph", "residus d'antibiotiques",
                          "résidus d'antibiotiques", "antibiotic residues"]),
    ("molecular_pcr", ["thermocycler", "thermal cycler", "cycleur thermique", "amplification",
                       "dna extraction", "adn", "primer", "amorce", "real-time pcr", "rt-pcr",
                       "qpcr", "nucleic acid", "isothermal amplification", "lysis buffer",
                       "polymerase chain reaction", "amplified", "hybridis", "ribosomal rna",
                       "rrna"]),
    ("flow_cytometry", ["flow cytometr", "cytometrie en flux", "cytometry", "epifluorescence",
                        "fluorescent labelling of cells", "optical counting"]),
    ("immunological_elisa", ["elisa", "monoclonal antibod", "polyclonal antibod", "immunocapture",
                             "immunoconcentration", "conjugate", "anticorps"]),
    ("culture_media", ["most probable number", "miniaturised", "miniaturized",
                       "nombre le plus probable"]),
]
MIN_EVIDENCE = 2
# Keywords used only for the list-and-detail registry, first match wins.
LIST_NAME_TECHNOLOGY = [
    ("petrifilm", "culture_media"), ("compact dry", "culture_media"),
    ("easy plate", "culture_media"), ("mc-media pad", "culture_media"),
    ("peelplate", "culture_media"), ("peel plate", "culture_media"),
    ("one plate", "culture_media"), ("count plate", "culture_media"),
    ("brilliance", "chromogenic_agar"), ("campyfood", "chromogenic_agar"),
    ("casa", "chromogenic_agar"), ("chromogenic", "chromogenic_agar"),
    ("pcr", "molecular_pcr"), (" gds ", "molecular_pcr"), ("iq-check", "molecular_pcr"),
    ("genetic detection", "molecular_pcr"),
    ("elisa", "immunological_elisa"), ("immunoassay", "immunological_elisa"),
    ("lateral flow", "immunological_elisa"), ("cytomet", "flow_cytometry"),
    ("maldi", "biochemical"), ("biotyper", "biochemical"), ("autof ms", "biochemical"),
    ("mass spectrometry", "biochemical"), ("soleris", "biochemical"), ("tempo", "biochemical"),
]
# Regular expressions over certificate sections, first match wins.
SECTION_TECHNOLOGY = [
    (r"\breal[- ]?time pcr\b|\bqpcr\b|\bpcr\b|amplification", "molecular_pcr"),
    (r"chromogenic|colou?r change", "chromogenic_agar"),
    (r"elisa|immunoassay|lateral flow|immuno-?concentrat", "immunological_elisa"),
]
# French section headings of the organism pages.
HEADING_TECHNOLOGY = {
    "milieux de culture": "culture_media",
    "méthodes moléculaires": "molecular_pcr",
    "methodes moleculaires": "molecular_pcr",
    "tests de biologie moléculaire": "molecular_pcr",
    "tests immunologiques": "immunological_elisa",
    "tests immuno-enzymatiques": "immunological_elisa",
    "tests imuno-enzymatiques": "immunological_elisa",
    "cytométrie en flux": "flow_cytometry",
    "cytometrie en flux": "flow_cytometry",
}
# Words that hint at a detection principle without asserting one.
EVIDENCE_HINTS = [
    "pcr", "amplification", "primer", "probe", "dna", "rna", "nucleic", "thermocycler",
    "thermal cycler", "isothermal", "hybridi", "antibod", "elisa", "immuno", "conjugate",
    "lateral flow", "cytometr", "fluoresc", "luminescen", "atp", "impedance", "conductance",
    "agar", "broth", "chromogenic", "medium", "media", "colony", "incubat", "inhibition",
    "bioassay", "spore", "enzymatic", "substrate", "principle", "principe", "technology",
    "detection is based",
]

# --- Fixed values: target organisms by keyword on upper-case text ------------
CERTIFICATE_TARGETS = [
    ("SALMONELLA", "Salmonella spp."), ("LISTERIA MONOCYTOGENES", "Listeria monocytogenes"),
    ("LISTERIA", "Listeria spp."), ("CRONOBACTER", "Cronobacter spp."),
    ("CAMPYLOBACTER", "Campylobacter spp."),
    ("SHIGA TOXIN", "Shiga toxin-producing E. coli (STEC)"),
    ("STEC", "Shiga toxin-producing E. coli (STEC)"),
    ("EHEC", "Shiga toxin-producing E. coli (STEC)"),
    ("PATHOGENIC E. COLI", "Shiga toxin-producing E. coli (STEC)"),
    ("E. COLI O157", "E. coli O157"), ("E. COLI", "E. coli"), ("COLIFORM", "Coliforms"),
    ("ENTEROBACTERIACEAE", "Enterobacteriaceae"),
    ("STAPHYLOCOCC", "Coagulase-positive staphylococci"), ("BACILLUS CEREUS", "Bacillus cereus"),
    ("YEAST AND MOLD", "Yeasts and molds"), ("PSEUDOMONAS", "Pseudomonas spp."),
    ("ANTIBIOTIC", "Antibiotic residues"),
]
LIST_TARGETS = [
    ("SALMONELLA", "Salmonella spp."), ("LISTERIA MONOCYTOGENES", "Listeria monocytogenes"),
    ("LISTERIA", "Listeria spp."), ("CRONOBACTER", "Cronobacter spp."),
    ("CAMPYLOBACTER", "Campylobacter spp."), ("STEC", "Shiga toxin-producing E. coli (STEC)"),
    ("E. COLI O157", "E. coli O157"), ("E. COLI", "E. coli"), ("COLIFORM", "Coliforms"),
    ("ENTEROBACTERIACEAE", "Enterobacteriaceae"),
    ("STAPHYLOCOCC", "Coagulase-positive staphylococci"), ("BACILLUS CEREUS", "Bacillus cereus"),
    ("YEAST AND MOLD", "Yeasts and molds"), ("PSEUDOMONAS", "Pseudomonas spp."),
    ("ANTIBIOTIC", "Antibiotic residues"),
    ("AEROBIC", "Aerobic mesophilic flora / total viable count"),
    ("LACTIC ACID BACTERIA", "Lactic acid bacteria"),
]
SLUG_ORGANISMS = {
    "salmonella": "Salmonella spp.",
    "listeria-monocytogenes": "Listeria monocytogenes",
    "listeria-spp": "Listeria spp.",
    "listeria-spp-et-listeria-monocytogenes": "Listeria spp. and L. monocytogenes",
    "coliformes": "Coliforms",
    "enterobacteriaceae": "Enterobacteriaceae",
    "e-coli": "E. coli",
    "e-coli-o157": "E. coli O157",
    "stec": "Shiga toxin-producing E. coli (STEC)",
    "cronobacter-spp-enterobacter-sakazakii": "Cronobacter spp.",
    "campylobacter-spp": "Campylobacter spp.",
    "staphylocoques-coagulase-positive": "Coagulase-positive staphylococci",
    "bacillus-cereus": "Bacillus cereus",
    "levures-moisissures": "Yeasts and molds",
    "pseudomonas-spp": "Pseudomonas spp.",
    "flore-totale": "Aerobic mesophilic flora / total viable count",
    "bacteries-lactiques-mesophiles": "Lactic acid bacteria",
    "antibiotiques": "Antibiotic residues",
}
ANALYTES = {
    "bacillus cereus group": "Bacillus cereus",
    "listeria spp.; listeria monocytogenes": "Listeria spp. and L. monocytogenes",
    "salmonella spp.; typing of 106 serovars": "Salmonella spp.",
}

# --- Fixed values: the 18 food categories of ISO 16140-2 Annex A, in order ---
FOOD_CATEGORIES = [
    ("raw_milk_dairy", "Raw milk and dairy products"),
    ("heat_processed_dairy", "Heat-processed milk and dairy products"),
    ("raw_meat", "Raw meat and ready-to-cook meat products (except poultry)"),
    ("rte_meat", "Ready-to-eat, ready-to-reheat meat products"),
    ("raw_poultry", "Raw poultry and ready-to-cook poultry products"),
    ("rte_poultry", "Ready-to-eat, ready-to-reheat meat poultry products"),
    ("eggs", "Eggs and egg products (derivates)"),
    ("raw_seafood", "Raw and ready-to-cook fish and seafoods (unprocessed)"),
    ("rte_seafood", "Ready-to-eat, ready-to-reheat fishery products"),
    ("fresh_produce", "Fresh produce and fruits"),
    ("processed_produce", "Processed fruits and vegetables"),
    ("dried_produce", "Dried cereals, fruits, nuts, seeds and vegetables"),
    ("infant_formula", "Infant formula and infant cereals"),
    ("chocolate_bakery", "Chocolate, bakery products and confectionary"),
    ("composite_foods", "Multi-component foods or meal components"),
    ("pet_food_feed", "Pet food and animal feed"),
    ("environmental_samples", "Environmental samples (food or feed production)"),
    ("primary_production_samples", "Primary production samples (PPS)"),
]
FOOD_WORDS = {
    "infant": ["infant formula", "infant cereal"],
    "bakery": ["cocoa", "chocolate", "bakery", "confection"],
    "feed": ["pet food", "animal feed", "feed stuff", "feed product"],
    "composite": ["composite", "multicomponent", "multi-component", "meal component"],
    "dried": ["dried", "dehydrat"],
    "poultry": ["poultry", "chicken", "turkey"],
    "meat": ["meat", "beef", "pork"],
    "seafood": ["seafood", "fish", "fishery", "shellfish", "crustacean"],
    "dairy": ["dairy", "milk", "cheese", "yog"],
    "produce": ["veget", "fruit", "produce", "salad"],
    "ready": ["rte", "rtrh", "ready-to-eat", "ready to eat", "ready-to-reheat",
              "ready to reheat", "cooked", "deli"],
    "heated": ["pasteuris", "pasteuriz", "heat process", "heat-process", "sterilis", "steriliz",
               "uht"],
    "processed": ["processed", "canned", "juice"],
}
NOT_MINED = "Not yet mined"
AGGREGATE_ROW = r"(?iU)^\s*(?:all\s+(?:categor|product|matri|protocol)|total\b|overall\b|global\b)"

# --- Fixed values: registries ------------------------------------------------
REGISTRY_URLS = {
    "NF-VALIDATION": "https://nf-validation.afnor.org/en/food-industry/",
    "MICROVAL": "https://microval.org/certified-methods/",
    "AOAC-RI": "https://www.aoac.org/scientific-solutions/performance-tested-methods/",
}
DETAIL_URL = "https://nen.bettywebblocks.com/view-microval-details?cert_nr={}&r_name=MicroVal"
STANDARDS_SHOP = "boutique.afnor.org"
EXCLUDED_SOURCES = ["AOAC-RI"]
MISSING_SCOPE = {
    "page": "(not published on the organism listing page; see certificate PDF)",
    "list": "(not published on MicroVal's public certificate listing)",
    "certificate": "(not stated in a single free-text scope field on this certificate)",
}
STUDY_PROTOCOL = {
    "NF-VALIDATION": "EN ISO 16140-2:2016",
    "MICROVAL": "EN ISO 16140-2:2016",
    "AOAC-RI": "AOAC Performance Tested Methods (PTM) Program",
}
LIST_COLUMNS = ["Analyte", "Certificate number", "Test kit name", "Supplier - manufacturer",
                "Expiry date", "Status"]
LIST_FIELDS = ["analyte_raw", "certificate_number", "commercial_name", "manufacturer_raw",
               "expiry_date_raw", "status_raw"]
DETAIL_LABELS = ["Test kit name", "Supplier - manufacturer", "Analyte", "Matrices",
                 "Reference method", "Certificate number", "First approval date", "Expiry date",
                 "Status", "Certificate issued by"]

# --- Fixed values: patterns of report text -----------------------------------
URL_NUMBER = (r"([A-Z0-9]{2,4})[_-](\d{2})[_-](\d{2})[_-](\d{2})[_-](\d{2})"
              r"(?:[_-]([A-Z])(?=[_.\-]|$))?")
BLOCK_ANCHOR = r"[A-Z0-9]{2,4} \d{2}/\d{2}-\d{2}/\d{2}(?: [A-Z])?\b"
DASHES = "-‐‑‒–—"
PRINTED_NUMBER = (r"(?:[A-Z0-9]{1,4}\s+)?\d{2}\s*/\s*\d{2}\s*[" + DASHES +
                  r"]\s*\d{2}\s*/\s*\d{2}(?:[A-Z])?")
NUMBER_LABEL = (r"(?:Certificate\s*(?:n(?:umber|o|°)|#)|Num[ée]ro\s+de\s+certificat|"
                r"N[o°]\s+de\s+certificat)\s*:?\s*\(?\s*")
PAGE_SIGNALS = [
    r"relative trueness|justesse relative",
    r"accuracy profile|profil d.exactitude",
    r"acceptability limit|limite d.acceptabilit",
    r"sensitivity|specificity|false positive|sensibilit",
    r"\bbias\b|\bbiais\b|standard deviation|ecart[- ]type",
    r"method comparison|comparaison des m[ée]thodes",
    r"\bLOD\b|\bRLOD\b|detection limit",
]
PAGE_NUMBER = r"-?\d+[.,]\d+"
PAGE_BUDGET = 14
TABLE_WORDS = r"(?i)trueness|bias|categor|accuracy profile|sensitivity|acceptability limit"
SECTION_HEADINGS = [
    ("authors", r"\bAUTHORS\b"),
    ("submitting_company", r"\bSUBMITTING COMPANY\b"),
    ("current_sponsor", r"\bCURRENT SPONSOR\b"),
    ("method_name_hdr", r"\bMETHOD NAME\b"),
    ("catalog_numbers", r"\bCATALOG NUMBERS?\b"),
    ("independent_laboratory", r"\bINDEPENDENT LABORATORY\b"),
    ("applicability", r"\bAPPLICABILITY OF METHOD\b"),
    ("certified_claim_statement", r"\bCERTIFIED CLAIM STATEMENT\b"),
    ("reference_method", r"\bREFERENCE METHODS? AND GUIDELINES\b|\bREFERENCE METHODS?\b"),
    ("original_certification_date", r"\bORIGINAL CERTIFICATION DATE\b"),
    ("certification_renewal_record", r"\bCERTIFICATION RENEWAL RECORD\b"),
    ("method_modification_record", r"\bMETHOD MODIFICATION RECORD\b"),
    ("summary_of_modification", r"\bSUMMARY OF MODIFICATION\b"),
    ("distributed_by", r"this method is distributed by:?"),
    ("distributed_as", r"this method is distributed as:?"),
    ("principle", r"\bPRINCIPLE OF THE METHOD\b"),
    ("discussion", r"\bDISCUSSION OF THE VALIDATION STUDY\b"),
    ("method_selectivity_table", r"Table\s*\d+\.\s*Method selectivity"),
    ("method_history_table", r"Table\s*\d+\.\s*Method history"),
    ("references_cited", r"\bREFERENCES CITED\b"),
]
ENGLISH_MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august",
                  "september", "october", "november", "december"]
FRENCH_MONTHS = ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août",
                 "septembre", "octobre", "novembre", "décembre"]
TOLERANCE = 0.05
REQUEST_QUOTA = 30
MAX_QUESTION = 500
MAX_SEARCH_TEXT = 60
MAX_ANSWER = 300
COLLAPSED_FACET = 8
BATCH_USD_PER_MTOK = {"input": 1.00, "output": 5.00}

# --- Fixed values: patterns of list documents, certificates and study reports.
# Flags: U takes white space, digits and words in the Unicode sense, d ends
# lines at line feeds only.
AIM_WORD = r"(?iU)\b(D[EÉé]TECTION|D[EÉé]NOMBREMENT|RECHERCHE)\b"
SCOPE_WORD = r"(\*?TOUS PRODUITS|\*?ALL HUMAN|\*?LES |\*?RAW |\*?VIANDE)"
COMPANY_HEADER = (r"(?sU)(?:Soci[ée]t[ée] [Tt]itulaire de la certification|"
                  r"Company holder of the certification)(.*?)N[°o] certificat")
LIST_DATE = r"(?U)[Ll]ist valid on\s*:?\s*(\d{2}[.\-/]\d{2}[.\-/]\d{4})"
RENEWAL_DATES = r"(?sU)RECONDUCTION/RENEWAL:\s*(.*?)(?:EXTENSION:|\z)"
EXTENSION_DATES = r"(?sU)EXTENSION:\s*(.*?)(?:RECONDUCTION/RENEWAL:|\z)"
HOLDER_NAME = r"(?U)certification\s*:?\s*([A-Z][A-Za-z0-9&.,'\- ]{2,60})"
PAGE_STANDARD = r"(?iU)\(selon\s+([^)]+)\)"
PAGE_UPDATED = r"(?iUd)mise à jour et publiée le\s+(.+)"
CERTIFICATE_NUMBER = r"(?U)Certificate No\.?\s*\n?\s*(\d+)"
CERTIFICATE_NAME = r"(?sU)hereby certifies the method known as\s*(.*?)\s*manufactured by"
CERTIFICATE_MAKER = r"(?sU)manufactured by\s*(.*?)\s*This method has been evaluated"
TARGET_CLAIM = (r"(?sU)(?:Target [Oo]rganisms?|Analyte)\s*[-–]\s*(.*?)"
                r"(?:Matrixe?s?\s*[-–]|Performance claims|\z)")
MATRIX_CLAIM = r"(?sU)Matrixe?s?\s*[-–]\s*(.*?)(?:Performance claims|\z)"
MATRIX_COLUMN = r"(?U)\n([A-Z][A-Za-z0-9 ()%.\-]{3,40}) \d+ (?:g|mL|cloth)\b"
STRAIN_ROW = r"(?mUd)^\s*\d+\s+(.*?)\s([+\-])[a-z]{0,2}\s*$"
INCLUSIVITY_STORY = (r"(?iUd)Of the (\d+) inclusivity strains.*?(all (\d+)|none)"
                     r"[^.]*correctly detected")
EXCLUSIVITY_STORY = (r"(?iUd)Of the (\d+) exclusivity strains,?\s*(none|all (\d+))\s*(?:were|was)?"
                     r"\s*detected")
SELECTIVITY_ROW = r"(?U)(\d+)[a-z]?\s+(\d+)\s+(\d+)[a-z]?\s+(\d+)\b"
LIMIT_SENTENCE = (r"(?U)Acceptability Limit[s]? (?:is |are )?fixed at\s*[±\+/\-]*\s*([\d,\.]+)"
                  r"\s*[Ll]og")
TESTED_SENTENCE = (r"(?U)(\d+) (?:additional )?target strains and (\d+)(?:\s+additional)? "
                   r"non-target strains were tested")
SAME_SENTENCE = (r"(?Ud)Same results were observed by both methods for (\d+) strains\.\s*For (\d+) "
                 r"strains?,\s*differences\s+were\s+observed:?\s*(.*?)(?:\s+Exclusivity\b|$)")
NON_TARGET_SENTENCE = (r"(?Ud)Among the (\d+) non\s*-\s*target strains? tested,\s*(\d+) strains? were not "
                       r"enum\s*\w*ed with the .+? method")
BOTH_METHODS_SENTENCE = r"(?Ud)strains were enumerated by both methods:\s*(.*?)\."
REPEATABILITY_LINE = r"(?U)SD Repeatability\s+([\d,\.]+)\s+([\d,\.]+)\s+\+/-\s*([\d,\.]+)"

# --- Fixed values: notes written into records --------------------------------
NOTE_NO_PAGE = ("No matching live organism-page record found; fields limited to what the bootstrap "
                "PDF-list import captured.")
NOTE_NO_LIST = ("No matching bootstrap PDF-list record found (likely a certificate added/renamed "
                "after the bootstrap PDF was issued); no renewal history or validation-scope text "
                "available yet.")
NOTE_LABEL = "MicroVal listing page label: "
NOTE_STATUS = ". Raw status text: "
NOTE_EXPIRY = ", raw expiry text: "
NOTE_NO_REPORT = "Study report not published on MicroVal's certificate detail page."
NOTE_REPORT = "Study report available for further mining."
NOTE_MISSED = "Not detected (result: "
NOTE_CROSS = "Cross-reactivity: detected (result: "
NOTE_COUNTED = "Counted from per-strain inclusivity/exclusivity table rows."
NOTE_ENUMERATED = "Cross-reactive: enumerated by the alternative method"
NOTE_CERTIFICATE = (
    "AOAC-RI certificate PDFs bundle certification metadata AND validation-study "
    "performance data in one document (unlike NF-Validation's separate cert + "
    "summary-report). Inclusivity/exclusivity extraction is best-effort text mining "
    "(narrative counts where stated, else counted from per-strain table rows -- "
    "table rows wrapped across two PDF text lines can be undercounted). The "
    "presumptive-vs-confirmed / vs-reference-method POD comparison tables are not "
    "yet mined (table layout is not reliably recoverable from PDF text extraction). "
    "This parser has only been developed against 4 example certificates; broaden "
    "coverage once more are available.")
