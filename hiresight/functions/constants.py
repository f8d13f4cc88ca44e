"""Fixed values that results depend on.

FIXED VALUES: every list and map below must keep these exact entries and this
exact order (the order is meaningful wherever "first match wins").  They are
stated plainly and in natural order on purpose; everything else in the package
is derived from them by code.
"""

from __future__ import annotations

# --- FIXED VALUES: domain keywords; a posting is in the IT domain if its lowered
# "title description" text contains any of them as a substring.
IT_KEYWORDS = [
    "python", "java", "javascript", "typescript", "c++", "c#", "php", "ruby", "go",
    "react", "angular", "vue", "nodejs", "django", "flask", "spring", "laravel",
    "backend", "frontend", "fullstack", "devops", "sre", "platform",
    "data scientist", "data engineer", "data analyst", "machine learning", "ai",
    "aws", "azure", "gcp", "docker", "kubernetes", "jenkins", "gitlab",
    "sql", "mysql", "postgresql", "mongodb", "redis", "elasticsearch",
    "tensorflow", "pytorch", "pandas", "numpy", "scikit-learn",
    "mobile", "ios", "android", "swift", "kotlin", "flutter",
    "qa", "tester", "automation", "selenium", "cypress",
    "security", "cybersecurity", "penetration testing",
]

# --- FIXED VALUES: market vocabulary of skills (one entry, redis, is listed twice
# in the source list; it is kept once here).
SKILL_VOCABULARY = [
    "python", "java", "javascript", "typescript", "c++", "c#", "php", "ruby", "go", "rust", "scala", "kotlin", "swift",
    "react", "angular", "vue", "nextjs", "nuxt", "svelte", "html", "css", "sass", "tailwind", "bootstrap",
    "nodejs", "express", "django", "flask", "fastapi", "spring", "springboot", "laravel", "asp.net", "rails",
    "aws", "azure", "gcp", "docker", "kubernetes", "k8s", "jenkins", "gitlab", "github actions", "terraform",
    "ansible", "prometheus", "grafana", "elk", "splunk", "cloudformation", "pulumi",
    "sql", "mysql", "postgresql", "mongodb", "redis", "elasticsearch", "cassandra", "dynamodb", "firebase",
    "pandas", "numpy", "scikit-learn", "tensorflow", "pytorch", "keras", "spark", "hadoop", "airflow",
    "dbt", "tableau", "powerbi", "looker", "databricks", "snowflake",
    "android", "ios", "react native", "flutter", "swiftui", "jetpack compose", "xamarin",
    "selenium", "cypress", "jest", "pytest", "junit", "testng", "postman", "soapui",
    "security", "cybersecurity", "penetration testing", "ethical hacking", "owasp", "burpsuite", "nmap",
    "git", "linux", "bash", "vim", "intellij", "vscode", "jira", "confluence", "agile", "scrum", "kanban",
    "microservices", "rest api", "graphql", "grpc", "kafka", "rabbitmq", "memcached",
]

# --- FIXED VALUES: skills kept after extraction (the whitelist).
VALID_IT_SKILLS = [
    "python", "java", "javascript", "typescript", "c++", "c#", "php", "ruby", "go",
    "react", "angular", "vue", "nextjs", "nodejs", "express", "django", "flask", "spring",
    "aws", "azure", "gcp", "docker", "kubernetes", "jenkins", "gitlab", "terraform",
    "sql", "mysql", "postgresql", "mongodb", "redis", "elasticsearch",
    "pandas", "numpy", "tensorflow", "pytorch", "scikit-learn", "spark",
    "android", "ios", "swift", "kotlin", "flutter", "react native",
    "selenium", "cypress", "pytest", "jest", "postman",
    "git", "linux", "bash", "jira", "confluence",
]

# --- FIXED VALUES: high-value skills.
HIGH_VALUE_SKILLS = ["python", "aws", "docker", "kubernetes", "devops", "tensorflow", "pytorch", "react"]

# --- FIXED VALUES: whole-word abbreviations recognised by the extractor.
ABBREVIATIONS = [("js", "javascript"), ("ts", "typescript"), ("py", "python"), ("rb", "ruby"),
                 ("go", "go"), ("k8s", "kubernetes"), ("tf", "tensorflow")]

# --- FIXED VALUES: words of a level, tested as substrings in this order.
EXPERIENCE_LEVEL_WORDS = [
    ("fresher", 0.0), ("intern", 0.0), ("entry", 0.5), ("junior", 1.0), ("middle", 3.0),
    ("senior", 5.0), ("lead", 6.0), ("manager", 7.0), ("director", 8.0),
]
DEFAULT_YEARS = 2.0

# --- FIXED VALUES: seniority thresholds (upper bounds, exclusive) and labels.
SENIORITY_BANDS = [(1.0, "Fresher"), (3.0, "Junior"), (5.0, "Middle"), (8.0, "Senior")]
SENIORITY_TOP = "Expert"

# --- FIXED VALUES: city keys tested as substrings in this order.
CITY_KEYS = [
    ("hà nội", "Hanoi"), ("ha noi", "Hanoi"), ("hanoi", "Hanoi"),
    ("hồ chí minh", "Ho Chi Minh City"), ("ho chi minh", "Ho Chi Minh City"),
    ("hcm", "Ho Chi Minh City"), ("hcmc", "Ho Chi Minh City"), ("saigon", "Ho Chi Minh City"),
    ("đà nẵng", "Da Nang"), ("da nang", "Da Nang"), ("danang", "Da Nang"),
    ("hải phòng", "Hai Phong"), ("hai phong", "Hai Phong"),
    ("cần thơ", "Can Tho"), ("can tho", "Can Tho"),
    ("bình dương", "Binh Duong"), ("binh duong", "Binh Duong"),
    ("đồng nai", "Dong Nai"), ("dong nai", "Dong Nai"),
]

# --- FIXED VALUES: long city key list (provinces) for the advanced cleaner.
CITY_KEYS_ADVANCED = [
    ("hà nội", "Hanoi"), ("ha noi", "Hanoi"), ("hanoi", "Hanoi"),
    ("hồ chí minh", "Ho Chi Minh City"), ("ho chi minh", "Ho Chi Minh City"),
    ("hcm", "Ho Chi Minh City"), ("hcmc", "Ho Chi Minh City"), ("saigon", "Ho Chi Minh City"),
    ("đà nẵng", "Da Nang"), ("da nang", "Da Nang"), ("danang", "Da Nang"),
    ("hải phòng", "Hai Phong"), ("hai phong", "Hai Phong"), ("haiphong", "Hai Phong"),
    ("cần thơ", "Can Tho"), ("can tho", "Can Tho"),
    ("bình dương", "Binh Duong"), ("binh duong", "Binh Duong"),
    ("đồng nai", "Dong Nai"), ("dong nai", "Dong Nai"),
    ("bắc ninh", "Bac Ninh"), ("bac ninh", "Bac Ninh"),
    ("quảng ninh", "Quang Ninh"), ("quang ninh", "Quang Ninh"),
    ("hưng yên", "Hung Yen"), ("hung yen", "Hung Yen"),
    ("hải dương", "Hai Duong"), ("hai duong", "Hai Duong"),
    ("vĩnh phúc", "Vinh Phuc"), ("vinh phuc", "Vinh Phuc"),
    ("thái nguyên", "Thai Nguyen"), ("thai nguyen", "Thai Nguyen"),
    ("nam định", "Nam Dinh"), ("nam dinh", "Nam Dinh"),
    ("nghệ an", "Nghe An"), ("nghe an", "Nghe An"),
    ("thanh hóa", "Thanh Hoa"), ("thanh hoa", "Thanh Hoa"),
    ("quảng nam", "Quang Nam"), ("quang nam", "Quang Nam"),
    ("bình định", "Binh Dinh"), ("binh dinh", "Binh Dinh"),
    ("khánh hòa", "Khanh Hoa"), ("khanh hoa", "Khanh Hoa"),
    ("lâm đồng", "Lam Dong"), ("lam dong", "Lam Dong"),
    ("đắk lắk", "Dak Lak"), ("dak lak", "Dak Lak"),
    ("gia lai", "Gia Lai"),
    ("kon tum", "Kon Tum"),
    ("bình thuận", "Binh Thuan"), ("binh thuan", "Binh Thuan"),
    ("bà rịa - vũng tàu", "Ba Ria Vung Tau"), ("vung tau", "Ba Ria Vung Tau"),
    ("long an", "Long An"),
    ("tiền giang", "Tien Giang"), ("tien giang", "Tien Giang"),
    ("bến tre", "Ben Tre"), ("ben tre", "Ben Tre"),
    ("trà vinh", "Tra Vinh"), ("tra vinh", "Tra Vinh"),
    ("vĩnh long", "Vinh Long"), ("vinh long", "Vinh Long"),
    ("đồng tháp", "Dong Thap"), ("dong thap", "Dong Thap"),
    ("an giang", "An Giang"),
    ("kiên giang", "Kien Giang"), ("kien giang", "Kien Giang"),
    ("cà mau", "Ca Mau"), ("ca mau", "Ca Mau"),
    ("bạc liêu", "Bac Lieu"), ("bac lieu", "Bac Lieu"),
    ("sóc trăng", "Soc Trang"), ("soc trang", "Soc Trang"),
    ("hậu giang", "Hau Giang"), ("hau giang", "Hau Giang"),
]
# words that mark a location string as a salary, advanced cleaner only
CITY_REJECT_WORDS = ["vnd", "triệu", "million"]

# --- FIXED VALUES: city salary multipliers; unmatched cities get CITY_MULTIPLIER_DEFAULT.
CITY_MULTIPLIERS = [
    ("Ho Chi Minh City", 1.15), ("Hanoi", 1.12), ("Da Nang", 1.0), ("Hai Phong", 0.95),
    ("Can Tho", 0.92), ("Binh Duong", 0.98), ("Dong Nai", 0.96), ("Other", 0.90),
]
CITY_MULTIPLIER_DEFAULT = 0.95
BIG_CITIES = ["Ho Chi Minh City", "Hanoi"]

# --- FIXED VALUES: skill combinations (all-of flags).
SKILL_COMBOS = [
    ("fullstack_data", ["python", "sql"]),
    ("devops_stack", ["python", "aws", "docker"]),
    ("fullstack_js", ["react", "nodejs"]),
    ("java_enterprise", ["java", "spring", "sql"]),
    ("cloud_native", ["aws", "docker", "kubernetes"]),
    ("ai_stack", ["python", "tensorflow"]),
    ("data_stack", ["python", "pandas", "numpy"]),
]

# --- FIXED VALUES: company size bands, right-closed (lo, hi].
COMPANY_SIZE_BANDS = [(0, 1, "Small"), (1, 3, "Medium"), (3, 10, "Large"), (10, None, "Enterprise")]

# --- FIXED VALUES: salary brackets, right-closed (lo, hi], million VND.
SALARY_BRACKETS = [(0, 10, "<10M"), (10, 15, "10-15M"), (15, 20, "15-20M"),
                   (20, 30, "20-30M"), (30, 50, "30-50M"), (50, 100, ">50M")]
BRACKET_LEVEL = {"<10M": "Fresher", "10-15M": "Junior", "15-20M": "Junior",
                 "20-30M": "Middle", "30-50M": "Senior", ">50M": "Expert"}

# --- FIXED VALUES: title pattern -> skills, used by the high-pay repair (ordered).
TITLE_SKILL_RULES = [
    ("python", ["python", "sql", "git"]),
    ("java", ["java", "spring", "sql", "git"]),
    ("javascript", ["javascript", "html", "css", "git"]),
    ("react", ["react", "javascript", "html", "css"]),
    ("angular", ["angular", "typescript", "javascript"]),
    ("devops", ["aws", "docker", "kubernetes", "linux", "jenkins"]),
    ("data", ["python", "sql", "pandas", "aws"]),
    ("frontend", ["javascript", "html", "css", "react"]),
    ("backend", ["java", "python", "sql", "git"]),
    ("fullstack", ["javascript", "python", "sql", "react", "nodejs"]),
    ("mobile", ["android", "ios", "swift", "kotlin"]),
    ("qa", ["selenium", "python", "git", "jenkins"]),
    ("security", ["security", "linux", "python", "aws"]),
    ("cloud", ["aws", "docker", "kubernetes", "terraform"]),
    ("database", ["sql", "postgresql", "mysql", "mongodb"]),
]
BASIC_SKILLS = ["python", "git", "sql"]

# --- FIXED VALUES: title pattern -> skills, used by the title-only repair (unordered adds).
TITLE_SKILL_RULES_ALT = [
    ("python", ["python", "sql", "git"]),
    ("java", ["java", "sql", "spring", "git"]),
    ("javascript", ["javascript", "html", "css", "git"]),
    ("react", ["react", "javascript", "html", "css", "redux"]),
    ("angular", ["angular", "typescript", "javascript", "html", "css"]),
    ("devops", ["aws", "docker", "kubernetes", "linux", "jenkins", "git"]),
    ("data scientist", ["python", "pandas", "numpy", "sql", "scikit-learn"]),
    ("data engineer", ["python", "sql", "spark", "airflow", "aws"]),
    ("frontend", ["javascript", "html", "css", "react", "git"]),
    ("backend", ["python", "java", "sql", "git", "docker"]),
    ("fullstack", ["javascript", "python", "sql", "react", "nodejs", "git"]),
    ("mobile", ["swift", "kotlin", "android", "ios", "git"]),
    ("qa", ["selenium", "pytest", "junit", "git"]),
    ("security", ["security", "aws", "linux", "python"]),
]

# --- FIXED VALUES: static skill -> suggested skills map of the dashboard (upper case;
# the key AWS appears twice in the source, the later list wins and is the one kept).
SKILL_SUGGESTIONS = [
    ("PYTHON", ["SQL", "GIT", "PANDAS", "AWS", "DOCKER"]),
    ("JAVA", ["SPRING", "SQL", "GIT", "DOCKER", "MICROSERVICES"]),
    ("JAVASCRIPT", ["REACT", "NODEJS", "TYPESCRIPT", "GIT", "SQL"]),
    ("REACT", ["JAVASCRIPT", "NODEJS", "REDUX", "GIT", "TYPESCRIPT"]),
    ("NODEJS", ["JAVASCRIPT", "EXPRESS", "MONGODB", "GIT", "SQL"]),
    ("AWS", ["DOCKER", "KUBERNETES", "TERRAFORM", "LINUX", "JENKINS"]),
    ("DOCKER", ["KUBERNETES", "AWS", "LINUX", "JENKINS", "GIT"]),
    ("SQL", ["PYTHON", "MONGODB", "POSTGRESQL", "GIT", "DATA ANALYSIS"]),
    ("GIT", ["GITHUB", "GITLAB", "CI/CD", "LINUX", "PYTHON"]),
    ("TENSORFLOW", ["PYTHON", "PANDAS", "KERAS", "DEEP LEARNING", "PYTORCH"]),
    ("KUBERNETES", ["DOCKER", "AWS", "HELM", "LINUX", "PROMETHEUS"]),
    ("DEVOPS", ["AWS", "DOCKER", "KUBERNETES", "JENKINS", "TERRAFORM"]),
    ("DATA", ["PYTHON", "SQL", "PANDAS", "AWS", "SPARK"]),
]

# --- FIXED VALUES: salary-text words.
NEGOTIABLE_WORDS_A = ["thoả thuận", "thỏa thuận", "negotiable", "cạnh tranh"]
NEGOTIABLE_WORDS_B = ["negotiable", "thoả thuận", "thỏa thuận", "cạnh tranh"]
MILLION_WORDS = ["triệu", "trieu"]
THOUSAND_WORDS = ["nghìn", "ngàn"]
UP_TO_WORDS_A = ["tới", "đến", "upto", "up to", "lên đến"]
FROM_WORDS_A = ["trên", "từ", "from"]
UP_TO_WORDS_B = ["up to", "upto", "lên đến", "tới", "đến"]
FROM_WORDS_B = ["from", "từ", "trên"]

# --- FIXED VALUES: remote / english patterns.
REMOTE_PATTERN = "remote|work from home|wfh|hybrid"
ENGLISH_PATTERN = "english|ielts|toeic|toefl"

# --- FIXED VALUES: page extraction words.
WORKING_FORMS = [("fulltime", "Fulltime"), ("parttime", "Parttime"), ("remote", "Remote"),
                 ("hybrid", "Hybrid"), ("freelance", "Freelance"), ("contract", "Contract"),
                 ("internship", "Internship"), ("onsite", "Onsite")]
NOISE_LINES = ["apply now", "save this job", "view company", "view more jobs",
               "other jobs at this company", "more jobs for you", "hot jobs", "jobs",
               "company", "tools", "blog", "premium recruitment zone"]
SALARY_HEADER_EXACT = ["negotiable", "thỏa thuận", "thoả thuận", "login to view salary"]
SALARY_HEADER_UNITS = ["vnd", "usd", "triệu", "trieu"]
SECTION_STOP_WORDS = ["your role", "responsibilities", "mô tả công việc", "your skills", "benefits"]
COMPANY_LEGAL_WORDS = ["công ty", "company", "tnhh", "jsc", "corp", "ltd"]

# --- FIXED VALUES: cluster naming thresholds are in operators/cluster.py (4 rules).
# --- FIXED VALUES: outlier formula constants are in operators/enrich.py.

# --- FIXED VALUES: skills that count as high value when a request is scored.
SERVING_HIGH_VALUE = ["python", "aws", "docker", "kubernetes", "devops"]

# --- FIXED VALUES: spelling variations of the advanced extractor (variation, standard name).
SKILL_VARIATIONS = [
    ("pyspark", "spark"), ("scikit", "scikit-learn"), ("sklearn", "scikit-learn"), ("tf", "tensorflow"),
    ("k8s", "kubernetes"), ("reactjs", "react"), ("vuejs", "vue"), ("node", "nodejs"), ("postgres", "postgresql"),
    ("mongo", "mongodb"), ("docker", "docker"), ("aws", "aws"), ("azure", "azure"), ("gcp", "gcp"), ("jenkins", "jenkins"),
]
