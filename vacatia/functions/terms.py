"""Word lists, dictionaries and constants that results depend on."""

from __future__ import annotations

# Markers that mean "no value", lower case.
NULL_MARKERS = (
    "", " ", "nan", "none", "null", "n/a", "na", "[]", "{}", "-", "…", "...", "thỏa thuận", "thoả thuận", "cạnh tranh", "thương lượng",
    "không xác định", "chưa xác định", "đang cập nhật", "0", "0.0", "chưa cập nhật",
)
NEGOTIABLE = (
    "thỏa thuận", "thoả thuận", "cạnh tranh", "thương lượng", "đăng nhập để xem mức lương", "công ty không công khai thông tin này",
    "negotiable", "competitive", "confidential", "open", "trao đổi khi phỏng vấn", "thương lượng khi phỏng vấn", "deal",
)
COMMISSION = ("hoa hồng", "thưởng", "kpi", "commission", "bonus")

# Money.
USD_VND = 25_400.0
HOURS_A_MONTH, DAYS_A_MONTH, MONTHS_A_YEAR = 160.0, 22.0, 12.0
MONTHLY_MIN_VND, MONTHLY_MAX_VND = 1_000_000.0, 500_000_000.0

# Words that say no experience is asked for.
NO_EXPERIENCE = (
    "không yêu cầu", "không cần", "chưa có kinh nghiệm", "chua co kinh nghiem", "no experience", "fresher", "intern",
    "thực tập sinh", "không đòi hỏi",
)

# Legal words of company names, in the order of their removal.
LEGAL_WORDS = (
    "công ty", "tnhh", "cổ phần", "cp", "mtv", "tập đoàn", "chi nhánh", "corporation", "corp", r"co\.,?\s*ltd", "ltd", "jsc", "inc",
    "group", "việt nam", "vietnam", "vn",
)
TITLE_STOPWORDS = ("tuyển", "dụng", "gấp", "cần", "việc", "làm", "nhân", "viên", "job", "hiring", "urgent")

# Levels and the words that show them, by tier; first match wins.
SENIORITY = ("Thực tập", "Mới tốt nghiệp", "Junior", "Middle", "Senior", "Trưởng nhóm/Quản lý")
UNKNOWN_LEVEL, OTHER_FAMILY = "Chưa rõ", "Khác"
LEVEL_OF_RAW = (
    ("Thực tập", ("thực tập", "thực tập sinh", "sinh viên", "trainee", "intern", "internship")),
    ("Mới tốt nghiệp", ("mới tốt nghiệp", "fresher", "entry level")),
    ("Trưởng nhóm/Quản lý", ("trưởng nhóm", "trưởng/phó phòng", "trưởng phòng", "phó phòng", "quản lý", "giám sát", "lead", "leader", "manager", "giám đốc", "director", "head", "cto", "tech lead")),
    ("Senior", ("senior", "chuyên viên cao cấp", "trên 4 năm", "trên 5 năm")),
    ("Junior", ("junior", "dưới 2 năm")),
    ("Middle", ("middle", "mid", "mid-level")),
)
LEVEL_OF_TITLE = (
    ("Thực tập", ("intern", "internship", "thực tập", "thực tập sinh", "trainee")),
    ("Mới tốt nghiệp", ("fresher", "mới tốt nghiệp", "entry level")),
    ("Trưởng nhóm/Quản lý", ("lead", "leader", "tech lead", "team lead", "trưởng nhóm", "manager", "giám đốc", "director", "head of", "cto", "engineering manager", "trưởng phòng", "phó phòng")),
    ("Senior", ("senior", "chuyên viên cao cấp", "sr.", "sr")),
    ("Junior", ("junior", "jr.", "jr")),
    ("Middle", ("middle", "mid-level", "mid level", "mid")),
)

# Job families with title words and telling skills; first match wins.
FAMILIES = (
    ("Kiểm thử (QA/QC)", ("tester", "qa", "qc", "quality assurance", "automation test", "manual test", "kiểm thử", "test engineer", "test lead", "software testing", "sqa"), ("Automation Test", "Unit Test")),
    ("Bảo mật", ("security", "soc", "pentest", "cyber", "an ninh mạng", "bảo mật", "infosec", "siem", "cybersecurity", "penetration tester", "appsec", "devsecops"), ()),
    ("Mobile", ("mobile", "flutter", "react native", "ios", "android", "swift", "kotlin"), ("Swift", "Kotlin", "Dart")),
    ("DevOps/Cloud", ("devops", "cloud", "sre", "sysadmin", "infrastructure", "hạ tầng", "kubernetes", "k8s", "docker", "aws", "azure", "gcp", "linux", "system admin", "ci/cd", "platform engineer", "site reliability"), ("Docker", "Kubernetes", "AWS", "Azure", "GCP", "CI/CD", "Linux")),
    ("Data/AI", ("data engineer", "big data", "etl", "data warehouse", "dwh", "spark", "kafka", "airflow", "hadoop", "kỹ sư dữ liệu", "data scientist", "data science", "machine learning", "ai engineer", "deep learning", "nlp", "computer vision", "trí tuệ nhân tạo", "khoa học dữ liệu", "data analyst", "phân tích dữ liệu", "bi analyst", "power bi", "tableau", "genai", "llm"), ("Machine Learning", "Data Engineering", "Big Data", "Kafka")),
    ("Hệ thống/Mạng", ("network engineer", "system engineer", "quản trị mạng", "helpdesk", "it support", "cisco", "mạng máy tính", "it helpdesk", "network admin"), ()),
    ("Phân tích nghiệp vụ (BA)", ("business analyst", "ba", "chuyên viên phân tích nghiệp vụ", "phân tích nghiệp vụ", "business analysis", "functional analyst"), ()),
    ("Quản lý sản phẩm/dự án", ("product manager", "product owner", "po", "project manager", "pm", "quản lý sản phẩm", "quản lý dự án", "scrum master", "delivery manager", "agile coach", "project lead"), ("Agile/Scrum",)),
    ("Thiết kế UI/UX", ("ui/ux", "ui ux", "ui", "ux", "designer", "thiết kế", "figma", "adobe xd", "user experience", "user interface", "giao diện", "product designer", "ux writer"), ()),
    ("Fullstack", ("fullstack", "full-stack", "full stack"), ()),
    ("Frontend", ("frontend", "front-end", "front end", "ui developer", "web frontend"), ("React", "Vue", "Angular", "HTML/CSS")),
    ("Backend", ("backend", "back-end", "back end", "software engineer", "developer", "lập trình viên", "kỹ sư phần mềm", "web developer", "java", "spring", "spring boot", "node", "nodejs", "python", "golang", "go", "php", ".net", "c#", "django", "fastapi", "laravel", "ruby", "rails", "c++"), ("Python", "Java", "Node.js", "C#", "C++", "Golang", "PHP", "Ruby", "SQL", "NoSQL", "GraphQL", "REST API", "Microservices")),
)

# Canonical skills and how they are written.
SKILLS = {
    "Python": ("python", "python3", "django", "fastapi", "flask"), "Java": ("java", "spring", "springboot", "spring boot", "hibernate"),
    "JavaScript": ("javascript", "js", "ecmascript"), "TypeScript": ("typescript",), "React": ("react", "reactjs", "react.js", "react native"),
    "Vue": ("vue", "vuejs", "vue.js", "nuxt", "nuxtjs"), "Angular": ("angular", "angularjs"),
    "Node.js": ("node", "nodejs", "node.js", "express", "expressjs", "nestjs"), "C#": ("c#", "csharp", ".net", "dotnet", ".net core", "asp.net"),
    "C++": ("c++", "cpp"), "C": ("ngôn ngữ c", "lập trình c", "c programming", "c language", "c/c++", "c / c++", "c, c++", "embedded c"),
    "Golang": ("golang", "go lang", "go language", "ngôn ngữ go", "go developer", "go engineer"), "PHP": ("php", "laravel", "symfony", "codeigniter"),
    "Ruby": ("ruby", "rails", "ruby on rails"), "Rust": ("rust",), "Swift": ("swift", "ios"), "Kotlin": ("kotlin", "android"), "Dart": ("dart", "flutter"),
    "SQL": ("sql", "mysql", "postgresql", "postgres", "sql server", "ms sql", "oracle", "sqlite"),
    "NoSQL": ("nosql", "mongodb", "mongo", "redis", "elasticsearch", "cassandra"),
    "HTML/CSS": ("html", "html5", "css", "css3", "sass", "scss", "tailwind", "bootstrap"), "Docker": ("docker", "container", "containerization"),
    "Kubernetes": ("kubernetes", "k8s"), "AWS": ("aws", "amazon web services", "ec2", "s3", "lambda"), "Azure": ("azure", "microsoft azure"),
    "GCP": ("gcp", "google cloud", "google cloud platform"), "CI/CD": ("ci/cd", "cicd", "jenkins", "gitlab ci", "github actions"),
    "Git": ("git", "github", "gitlab", "bitbucket"), "Linux": ("linux", "ubuntu", "centos", "debian"), "Kafka": ("kafka", "apache kafka"),
    "RabbitMQ": ("rabbitmq",), "GraphQL": ("graphql",), "REST API": ("rest", "restful", "rest api", "api"),
    "Microservices": ("microservices", "microservice"), "Unit Test": ("unit test", "unit testing", "junit", "pytest", "jest"),
    "Automation Test": ("automation test", "selenium", "cypress", "playwright", "appium"),
    "Machine Learning": ("machine learning", "ml", "deep learning", "tensorflow", "pytorch", "scikit-learn", "ai/ml", "ai engineer", "ai developer", "trí tuệ nhân tạo", "artificial intelligence", "học máy"),
    "Data Engineering": ("data engineer", "data engineering", "spark", "hadoop", "airflow", "etl"), "Big Data": ("big data", "bigquery", "snowflake"),
    "Agile/Scrum": ("agile", "scrum", "kanban", "jira"),
}
# Benefits and how they are written.
BENEFITS = {
    "Bảo hiểm": ("bảo hiểm", "bảo hiểm sức khỏe", "bảo hiểm xã hội", "bhxh", "bhyt", "bhtn", "bảo hiểm 24/7", "bảo hiểm cao cấp", "chăm sóc sức khỏe", "health insurance", "social insurance", "medical coverage", "healthcare", "premium healthcare"),
    "Lương tháng 13": ("lương tháng 13", "tháng 13", "tháng lương 13", "13th month salary", "13th-month salary", "13 month salary", "bonus 13"),
    "Thưởng": ("thưởng", "thưởng hiệu suất", "thưởng tết", "thưởng dự án", "thưởng quý", "thưởng năm", "kpi bonus", "performance bonus", "yearly bonus", "annual bonus", "project bonus"),
    "Khám sức khỏe": ("khám sức khỏe", "khám sức khoẻ", "khám sức khỏe định kỳ", "khám sức khỏe hàng năm", "annual health check", "health check", "periodic health check"),
    "Nghỉ phép": ("nghỉ phép", "ngày phép", "phép năm", "12 ngày phép", "14 ngày phép", "15 ngày phép", "annual leave", "paid leave", "vacation days"),
    "Đào tạo": ("đào tạo", "training", "khóa học", "chứng chỉ", "hỗ trợ học phí", "trợ cấp học tập", "training course", "certifications", "learning budget"),
    "Du lịch": ("du lịch", "company trip", "team building", "teambuilding", "nghỉ mát", "annual trip", "outing trip"),
    "Thiết bị làm việc": ("macbook", "laptop", "thiết bị làm việc", "máy tính", "cung cấp thiết bị", "work equipment", "equipment provided"),
    "Làm việc linh hoạt": ("hybrid", "remote", "làm việc từ xa", "linh hoạt thời gian", "flexible hours", "work from home", "wfh"),
    "Phụ cấp ăn uống": ("cơm trưa", "phụ cấp ăn trưa", "trợ cấp ăn trưa", "lunch allowance", "free snack", "happy hour", "trà cà phê", "bữa trưa"),
}
# Tags that are categories of work, not skills.
CATEGORY_TAGS = r"^việc làm|^it\s*-\s*phần mềm|^công nghệ thông tin|^lập trình viên$|^nhân viên|^chuyên viên"

# Provinces as key: (name, former provinces and other spellings).
PROVINCES = {
    "tuyen_quang": ("Tuyên Quang", "Hà Giang"), "cao_bang": ("Cao Bằng",), "lai_chau": ("Lai Châu",), "lao_cai": ("Lào Cai", "Yên Bái"),
    "thai_nguyen": ("Thái Nguyên", "Bắc Kạn", "Bắc Cạn"), "dien_bien": ("Điện Biên",), "lang_son": ("Lạng Sơn",), "son_la": ("Sơn La",),
    "phu_tho": ("Phú Thọ", "Hòa Bình", "Vĩnh Phúc", "Hoà Bình"), "bac_ninh": ("TP. Bắc Ninh", "Bắc Giang", "Bắc Ninh"),
    "quang_ninh": ("TP. Quảng Ninh", "Quảng Ninh", "Hạ Long"), "ha_noi": ("TP. Hà Nội", "Hà Nội", "Hanoi", "HN"),
    "hai_phong": ("TP. Hải Phòng", "Hải Dương", "Hải Phòng"), "hung_yen": ("Hưng Yên", "Thái Bình"), "ninh_binh": ("Ninh Bình", "Hà Nam", "Nam Định"),
    "thanh_hoa": ("Thanh Hóa", "Thanh Hoá"), "nghe_an": ("Nghệ An",), "ha_tinh": ("Hà Tĩnh",), "quang_tri": ("Quảng Trị", "Quảng Bình"),
    "hue": ("TP. Huế", "Thừa Thiên Huế", "Huế", "Thừa Thiên - Huế"), "da_nang": ("TP. Đà Nẵng", "Quảng Nam", "Đà Nẵng", "Danang"),
    "quang_ngai": ("Quảng Ngãi", "Kon Tum", "Kontum"), "gia_lai": ("Gia Lai", "Bình Định", "Quy Nhơn"),
    "dak_lak": ("Đắk Lắk", "Phú Yên", "Đăk Lăk", "Daklak", "Buôn Ma Thuột"), "khanh_hoa": ("Khánh Hòa", "Ninh Thuận", "Khánh Hoà", "Nha Trang"),
    "lam_dong": ("Lâm Đồng", "Đắk Nông", "Bình Thuận", "Đăk Nông", "Đà Lạt"), "dong_nai": ("TP. Đồng Nai", "Bình Phước", "Đồng Nai", "Biên Hòa"),
    "ho_chi_minh": ("TP. Hồ Chí Minh", "Bình Dương", "Hồ Chí Minh", "Bà Rịa - Vũng Tàu", "HCM", "TPHCM", "Sài Gòn", "Saigon", "Vũng Tàu", "Bà Rịa", "Thủ Đức"),
    "tay_ninh": ("Tây Ninh", "Long An"), "dong_thap": ("Đồng Tháp", "Tiền Giang"), "an_giang": ("An Giang", "Kiên Giang", "Phú Quốc"),
    "vinh_long": ("Vĩnh Long", "Bến Tre", "Trà Vinh"), "can_tho": ("TP. Cần Thơ", "Sóc Trăng", "Hậu Giang", "Cần Thơ"), "ca_mau": ("Cà Mau", "Bạc Liêu"),
}
REMOTE = ("remote", "làm việc từ xa", "work from home", "wfh", "từ xa")
ABROAD = (
    "singapore", "japan", "nhật bản", "tokyo", "osaka", "korea", "hàn quốc", "seoul", "usa", "hoa kỳ", "australia", "germany", "malaysia",
    "thailand", "thái lan", "philippines", "indonesia", "china", "trung quốc", "taiwan", "đài loan", "hong kong", "cambodia", "campuchia",
    "london", "canada", "dubai", "europe", "overseas", "nước ngoài",
)

# Words that show an IT posting, others, and technical skills.
IT_WORDS = (
    "it", "cntt", "công nghệ thông tin", "developer", "dev", "lập trình", "lap trinh", "programmer", "software", "phần mềm", "phan mem",
    "data", "dữ liệu", "tester", "qa", "qc", "devops", "sre", "cloud", "backend", "back-end", "frontend", "front-end", "fullstack",
    "full-stack", "full stack", "mobile", "android", "ios", "web", "ai", "machine learning", "ml", "deep learning", "game", "unity",
    "product owner", "business analyst", "ba", "scrum", "erp", "sap", "odoo", "database", "dba", "ui/ux", "ux", "ui", "automation test",
    "embedded", "blockchain", "python", "java", "javascript", "typescript", ".net", "dotnet", "php", "react", "reactjs", "angular", "vue",
    "node", "nodejs", "golang", "c++", "c#", "kotlin", "flutter", "swift", "helpdesk", "it support", "cyber security", "phân tích nghiệp vụ",
    "hệ thống thông tin", "phát triển ứng dụng", "kiến trúc hệ thống", "mis", "ngân hàng lõi", "core banking", "kỹ sư giải pháp",
    "solution engineer", "bảo mật", "an ninh mạng", "network", "quản trị mạng", "quản trị hệ thống", "system admin", "sysadmin",
    "solution architect", "tech lead", "technical lead", "cto", "kỹ sư phần mềm", "salesforce", "crm developer",
)
OTHER_WORDS = (
    "kế toán", "ke toan", "accountant", "accounting", "kiểm toán", "tài xế", "lái xe", "driver", "giáo viên", "giảng viên", "giảng dạy",
    "teacher", "gia sư", "nhân sự", "hr", "tuyển dụng", "recruiter", "marketing", "bán hàng", "ban hang", "sales", "kinh doanh", "telesales",
    "tuyển sinh", "giao hàng", "shipper", "hành chính", "logistics", "xuất nhập khẩu", "thu ngân", "chăm sóc khách hàng", "cskh", "lễ tân",
    "bảo vệ", "bảo an", "tạp vụ", "phục vụ", "đầu bếp", "bếp", "thủ kho", "kho", "kỹ sư xây dựng", "công trình", "cơ khí", "điện công nghiệp",
    "điện lạnh", "may mặc", "dược", "y tá", "điều dưỡng", "bác sĩ", "luật", "pháp chế", "thư ký", "trợ lý giám đốc", "content writer",
    "content creator", "sáng tạo nội dung", "seo", "thiết kế đồ họa", "graphic designer", "kiến trúc sư", "nội thất", "bất động sản",
    "bảo hiểm", "giao dịch viên", "tư vấn khách hàng", "tín dụng", "thu mua", "purchasing", "sản xuất", "công nhân", "vận hành máy",
    "nhà hàng", "khách sạn",
)
TECH_SKILLS = (
    "python", "java", "javascript", "typescript", "sql", "mysql", "postgresql", "mongodb", "redis", "react", "reactjs", "angular", "vue",
    "vuejs", "nodejs", "node.js", "php", "laravel", "golang", "go", "c#", ".net", "c++", "kotlin", "swift", "flutter", "android", "ios",
    "docker", "kubernetes", "aws", "azure", "gcp", "linux", "git", "devops", "spring", "spring boot", "django", "html", "css",
    "machine learning", "ai", "data analysis", "power bi", "tableau", "tester", "testing", "selenium", "automation test", "qa", "qc", "sap",
    "erp", "odoo", "blockchain", "unity", "network", "security", "cloud", "microservices", "rest api", "api", "big data", "spark", "hadoop", "etl",
)
MIN_TECH_SKILLS = 2

# English phrases of postings and what they become, in order.
EN_VI = (
    ("job description", "mô tả công việc"), ("responsibilities", "trách nhiệm công việc"), ("key responsibilities", "trách nhiệm chính"),
    ("requirements", "yêu cầu ứng viên"), ("job requirements", "yêu cầu công việc"), ("qualifications", "năng lực và bằng cấp"),
    ("benefits", "quyền lợi và đãi ngộ"), ("why you'll love working here", "tại sao bạn sẽ yêu thích làm việc tại đây"),
    ("what we offer", "chế độ đãi ngộ chúng tôi cung cấp"), ("full-time", "toàn thời gian"), ("part-time", "bán thời gian"),
    ("remote", "làm việc từ xa"), ("hybrid", "làm việc kết hợp văn phòng và từ xa"), ("onsite", "làm việc tại văn phòng"),
    ("years of experience", "năm kinh nghiệm"), ("health insurance", "bảo hiểm sức khỏe"), ("social insurance", "bảo hiểm xã hội"),
    ("performance bonus", "thưởng hiệu suất"), ("13th month salary", "lương tháng 13"), ("annual leave", "nghỉ phép hàng năm"),
    ("competitive salary", "mức lương cạnh tranh"), ("negotiable", "thỏa thuận"),
)
VI_MARKERS = ("công việc", "yêu cầu", "quyền lợi", "kinh nghiệm", "lương", "chúng tôi", "ứng viên", "bảo hiểm")
EN_MARKERS = ("responsibilities", "requirements", "qualifications", "benefits", "experience", "salary", "team", "working")
#: Vietnamese letters with marks, lower case.
VI_LETTERS = "ăâđêôơưàáạảãằắặẳẵầấậẩẫèéẹẻẽềếệểễìíịỉĩòóọỏõồốộổỗờớợởỡùúụủũừứựửữỳýỵỷỹ"

MIN_WORDS = 30
TOP_PROVINCES, SKILL_MIN_COUNT, SKILL_MOST = 10, 20, 200
