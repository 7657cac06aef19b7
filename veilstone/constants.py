"""Labels, patterns and word lists that results depend on."""

# Unicode word, digit and space classes; Java's own are ASCII only.
W = r"[\p{L}\p{N}_]"
D = r"\p{Nd}"
S_IN = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}"  # inside a class
S = f"[{S_IN}]"


def start(first: str) -> str:
    """Word boundary before a word character of the class: the cheap class test comes before the look-behind."""
    return f"(?={first})(?<!{W})"


END = f"(?!{W})"  # word boundary after a word character

LETTERS = "a-zA-ZİıſK"  # of a class of Latin letters in any case

IMAGE_EXTENSIONS = [".jpg", ".jpeg", ".png", ".bmp", ".webp", ".tiff"]
DOCUMENT_EXTENSIONS = [".html", ".htm", ".pdf", ".docx", ".txt"]

NER_MODELS = {
    "HiNER": "cfilt/HiNER-original-muril-base-cased",
    "IndicNER": "ai4bharat/IndicNER",
    "BERT_NER": "dslim/bert-base-NER",
    "XLM_RoBERTa": "Babelscape/wikineural-multilingual-ner",
}

DISPLAY_NAMES = {
    "Aadhaar": "Aadhaar",
    "PAN": "PAN",
    "Phone_Number": "Phone Number",
    "Email": "Email",
    "Medical_UHID": "Medical UHID",
    "Passport": "Passport",
    "Voter_ID": "Voter ID",
    "Vehicle_Number": "Vehicle Number",
    "Bank_Account": "Bank Account",
    "Credit_Card": "Credit Card",
    "DOB": "Date of Birth",
    "PPP_ID": "PPP ID",
}

# Patterns in scan order, in Java syntax.
PATTERNS = {
    "Aadhaar": rf"{start(D)}{D}{{4}}[{S_IN}\-]?{D}{{4}}[{S_IN}\-]?{D}{{4}}{END}",
    "PAN": rf"{start('[A-Z]')}[A-Z]{{5}}{D}{{4}}[A-Z]{END}",
    "Phone_Number": rf"(?:\+?91[{S_IN}\-]?)?[6-9]{D}{{9}}{END}|\+91[{S_IN}\-]?{D}{{2}}[{S_IN}\-]?{D}{{4}}[{S_IN}\-]?{D}{{4}}{END}",
    # letters in any case, spelt out, and a start that no other of the word is tried after: many times faster
    "Email": rf"(?:\G|(?<![{LETTERS}0-9._%+\-]))[{LETTERS}0-9._%+\-]+@[{LETTERS}0-9.\-]+\.[{LETTERS}]{{2,}}",
    "Medical_UHID": rf"(?iu){start('[UPIE]')}(?:UHID|PMRN|IPD|EPISODE)[{S_IN}:.\-]*[A-Z]{{2,6}}[.\-]?{D}{{5,15}}{END}",
    "Passport": rf"{start('[A-Y]')}[A-PR-WY][1-9]{D}{{7}}{END}",
    "Voter_ID": rf"{start('[A-Z]')}[A-Z]{{3}}{D}{{7}}{END}",
    "Vehicle_Number": rf"{start('[A-Z]')}[A-Z]{{2}}[{S_IN}\-]?{D}{{2}}[{S_IN}\-]?[A-Z]{{1,2}}[{S_IN}\-]?{D}{{4}}{END}",
    "Bank_Account": rf"(?={D})(?<!{D}){D}{{14,18}}(?!{D})",
    "Credit_Card": rf"{start('[3-5]')}(?:4{D}{{12}}(?:{D}{{3}})?|5[1-5]{D}{{14}}|3[47]{D}{{13}}){END}",
    "DOB": rf"{start(D)}(?:0?[1-9]|[12]{D}|3[01])[/\-.](?:0?[1-9]|1[0-2])[/\-.](?:19|20){D}{{2}}{END}",
    "PPP_ID": rf"{start('[PF]')}(?:PPP|PPPID|FAMILYID|FID)[_\-:{S_IN}]*[A-Z0-9]{{6,10}}{END}",
}
TITLE_NAME = rf"(?iu){start('[SMDPK]')}(?:Shri|Sri|Smt|Mr|Mrs|Ms|Miss|Dr|Prof|Kumar|Kumari)\.?(?:{S}*[A-Z]\.)*{S}*[A-Z][a-zA-Z]+(?:{S}+[A-Z][a-zA-Z]+)*{END}"

CITIES = sorted(
    [
        "bangalore", "bengaluru", "mumbai", "delhi", "new delhi", "chennai", "kolkata",
        "hyderabad", "pune", "ahmedabad", "jaipur", "lucknow", "bhubaneswar", "gachibowli",
        "kalinga nagar", "secunderabad", "noida", "gurugram", "gurgaon", "visakhapatnam",
        "vijayawada", "jalaun", "orai",
    ]
)

EXCLUDED_ORGS = [
    "INSTITUTE", "SCIENCES", "HOSPITAL", "UNIVERSITY", "ACADEMY", "DEPARTMENT", "LABORATORY",
    "AUTHORITY", "MINISTRY", "FOUNDATION", "BIOCHEMISTRY", "GASTROENTEROLOGY", "DIAGNOSTIC", "PATHOLOGY",
]

NOISE_WORDS = [
    "The", "A", "An", "In", "On", "At", "To", "Of", "For", "And", "But", "Or", "Is", "Are",
    "Name", "Date", "Address", "Phone", "Email", "Report", "Page", "Clinical", "Patient",
    "Method", "Sample", "Type", "Unit", "Result", "Serum", "Test", "End",
]

DIGIT_LOOKALIKES = ("OolISB", "001158")
