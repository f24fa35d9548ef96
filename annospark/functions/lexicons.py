"""Word lists, dictionaries and names the results depend on.

All are defaults; every operator that uses one takes it as a parameter.
"""

# --- fixed values: vote columns of the annotated table ---------------------
LABELS = (
    "toxicity",
    "identity_attack",
    "threat_incitement_to_violence",
    "insults",
    "profanity_obscenity",
    "sexually_explicit",
    "polarized",
    "related_to_election_2024",
    "is_noise_or_spam_text",
)

SUB_LABELS = (
    "identity_attack",
    "threat_incitement_to_violence",
    "insults",
    "profanity_obscenity",
    "sexually_explicit",
)

#: The three outcomes of a majority vote.
VOTE_OUTCOMES = (0.0, 0.5, 1.0)

# --- fixed values: names of the agreement groups ---------------------------
NO_DISAGREEMENT = "Tanpa Disagreement"
EVEN_DISAGREEMENT = "Disagreement (50:50)"
UNEVEN_DISAGREEMENT = "Disagreement (Tidak 50:50)"
UNKNOWN_AGREEMENT = "Unknown"

# --- fixed values: negations that are never removed ------------------------
NEGATIONS = ("tidak", "bukan", "jangan", "belum", "tanpa", "tak", "gak", "nggak")

# --- fixed values: conservative stop words ---------------------------------
STOP_WORDS = (
    "yang", "dan", "di", "ke", "dari", "dengan", "untuk", "pada", "dalam",
    "adalah", "itu", "ini", "ada", "juga", "atau", "oleh", "sebagai", "karena",
    "jadi", "sudah", "akan", "saya", "aku", "kamu", "dia", "mereka", "kita",
    "kami", "nya", "pun", "lah", "kah", "para", "sebuah", "seorang", "tersebut",
    "saat", "ketika", "agar", "supaya", "hingga", "sampai", "lebih", "sangat",
    "bisa", "dapat", "buat", "sama", "aja", "ya", "yg", "kok", "sih", "nih",
    "tuh",
)

# --- fixed values: stop words of the early and the agreement analysis ------
STOP_WORDS_EARLY = (
    "yang", "di", "dan", "ini", "itu", "untuk", "dengan", "dari", "ke", "pada",
    "dalam", "adalah", "juga", "tidak", "ada", "orang", "yg", "ya", "aja",
    "kalo", "buat", "sama", "bisa", "karena", "kalau", "akan", "aku", "saya",
    "dia", "mereka", "kita", "kamu", "udah", "gak", "nya", "kok", "sih", "lagi",
    "lebih", "banyak", "sudah", "baru", "jadi",
)
STOP_WORDS_AGREEMENT = STOP_WORDS_EARLY + ("ga", "nggak", "tak")

# --- fixed values: slang added to a general stop list for word clouds ------
SLANG_STOP_WORDS = (
    "yg", "aja", "kalo", "buat", "sama", "udah", "gak", "nya", "kok", "sih",
    "nih", "tuh",
)

# --- fixed values: slang dictionary for exploration ------------------------
SLANG_FORMS = {
    "gak": "tidak", "ga": "tidak", "nggak": "tidak", "tdk": "tidak",
    "tak": "tidak", "yg": "yang", "dgn": "dengan", "dr": "dari",
    "krn": "karena", "karna": "karena", "kalo": "kalau", "kl": "kalau",
    "udh": "sudah", "udah": "sudah", "blm": "belum", "bgt": "banget",
    "banget": "sangat", "aja": "saja", "sm": "sama", "gw": "saya/aku",
    "gue": "saya/aku", "lu": "kamu", "lo": "kamu", "org": "orang",
    "jd": "jadi", "jgn": "jangan",
}

# --- fixed values: slang dictionary for cleaning (no negations) ------------
SLANG_NORMAL = {
    "yg": "yang", "dgn": "dengan", "dr": "dari", "krn": "karena",
    "karna": "karena", "kalo": "kalau", "kl": "kalau", "udh": "sudah",
    "udah": "sudah", "blm": "belum", "bgt": "banget", "aja": "saja",
    "sm": "sama", "org": "orang", "jd": "jadi", "jgn": "jangan",
    "gw": "saya", "gue": "saya", "lu": "kamu", "lo": "kamu",
}

# --- fixed values: English words that hint at code-mixing ------------------
ENGLISH_MARKERS = (
    "the", "and", "is", "are", "you", "your", "this", "that", "of", "to",
    "for", "with", "not", "fuck", "shit", "stupid",
)

# --- fixed values: words read as null in a CSV field -----------------------
NULL_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# --- fixed values: annotator dimension -------------------------------------
GENERATIONS = ((12, 29, "Gen Z"), (30, 44, "Millenials"), (45, 59, "Gen X"))
HOUSEWIFE = "Ibu Rumah Tangga"
NOT_WORKING = "Tidak Bekerja"
NO_CANDIDATE = "Tidak ada"
CANDIDATES = {
    "1": "Anies Rasyid Baswedan-Muhaimin Iskandar",
    "2": "Prabowo Subianto-Gibran Rakabuming Raka",
    "3": "Ganjar Pranowo-Mahfud MD",
}

# --- fixed values: prompt wording ------------------------------------------
POLARIZATION_PREFIX = {
    "id": "Nilai polarisasi rata-rata (rentang 0 hingga 1): ",
    "en": "Average polarization value (range of 0 to 1): ",
}
DEMOGRAPHIC_HEADER = {
    "id": "Informasi Demografis:",
    "en": "Demographic Information:",
}
DEMOGRAPHIC_ABSENT = {
    "id": "Informasi Demografis: Tidak tersedia",
    "en": "Demographic Information: Not available",
}
COMBINED_ABSENT = {
    "id": "Informasi Demografis dan Toksisitas: Tidak tersedia",
    "en": "Demographic Information and Toxicity: Not available",
}
DEMOGRAPHIC_NAMES = {
    "id": {
        "ethnicity": "etnisitas",
        "religion": "agama",
        "disability": "disabilitas",
        "lgbt": "lgbt",
        "gender": "gender",
        "age_group": "generasi",
        "domisili": "domisili",
        "pendidikan terakhir": "pendidikan terakhir",
        "status pekerjaan": "status pekerjaan",
        "president vote leaning": "pilihan presiden",
    },
    "en": {
        "ethnicity": "ethnicity",
        "religion": "religion",
        "disability": "disability",
        "lgbt": "lgbt",
        "gender": "gender",
        "age_group": "generation",
        "domisili": "domicile",
        "pendidikan terakhir": "last education level",
        "status pekerjaan": "job status",
        "president vote leaning": "president vote leaning",
    },
}

# --- fixed values: what to do about each element of a text -----------------
ELEMENT_ADVICE = {
    "url": "ganti token khusus <URL> bila cukup sering; isi URL biasanya tidak perlu dipertahankan",
    "mention": "ganti token <USER> untuk mengurangi sparsity tanpa kehilangan sinyal adanya mention",
    "hashtag": "pertahankan isi hashtag atau pisahkan tanda #; dapat membawa topik/stance penting",
    "digit": "pertahankan atau normalisasi <NUM> sesuai konteks; jangan hapus otomatis",
    "emoji": "pertahankan atau konversi ke deskripsi/token emoji karena bisa membawa emosi/sarkasme",
    "repeated_punctuation": "normalisasi jumlahnya tetapi pertahankan sinyal intensitas",
    "allcaps": "jika lowercase dilakukan, pertimbangkan fitur/token penanda ALLCAPS agar intensitas tidak hilang",
    "newline": "normalisasi ke spasi bila tidak bermakna struktural",
    "non_alphanumeric": "bersihkan selektif; jangan menghapus emoji/hashtag/punctuation emosional secara membabi buta",
}

# --- fixed values: threshold grids -----------------------------------------
BINARY_THRESHOLDS = (0.15, 0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50)
LABEL_THRESHOLD_RANGES = {
    "identity_attack": (0.25, 0.45),
    "insults": (0.25, 0.45),
    "profanity_obscenity": (0.15, 0.35),
    "threat": (0.10, 0.25),
    "sexually_explicit": (0.10, 0.25),
}
COVERAGE_LENGTHS = (128, 256, 384)
SINGLE_ANNOTATOR_WEIGHT = 0.7
TIE_WEIGHT = 0.5
CASCADE_LIMIT = 0.30
