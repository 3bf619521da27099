"""The built-in rule pack: dangerous calls fed from the request, and calls that are risky in themselves.

Both kinds come from short tables.  Packs in JSON or YAML files (``codesieve.sources.packs``) can replace or
extend them.
"""

from __future__ import annotations

import re

from codesieve.sources.rules import Rule

CWE_NAMES = {
    "CWE-22": "path traversal", "CWE-78": "command injection", "CWE-79": "cross-site scripting",
    "CWE-89": "SQL injection", "CWE-94": "code injection", "CWE-95": "eval injection", "CWE-98": "file inclusion",
    "CWE-209": "error details disclosed", "CWE-295": "certificate validation", "CWE-319": "cleartext transmission",
    "CWE-327": "weak cryptography", "CWE-502": "unsafe deserialization", "CWE-601": "open redirect",
    "CWE-611": "XML external entities", "CWE-918": "server-side request forgery",
}

# How values from a request are written in each language.
REQUEST_VALUE = {
    "php": r"\$_(?:GET|POST|REQUEST|COOKIE|SERVER)\b",
    "javascript": r"\breq(?:uest)?\s*\.\s*(?:query|body|params|headers|cookies)\b",
    "python": r"\brequest\s*\.\s*(?:args|form|values|json|data|files|cookies|headers|GET|POST|query_params)\b",
    "java": r"\bget(?:Parameter|Header|QueryString|Cookies)\w*\s*\(",
    "csharp": r"\bRequest\s*(?:\.\s*(?:Query|Form|Params|QueryString|Cookies|Headers)\b|\[)",
}

# (language, vulnerability type, weakness, severity, calls that must not see a request value on the same line)
REQUEST_CALLS = [
    ("php", "command_injection", "CWE-78", 10, "exec system shell_exec passthru popen proc_open pcntl_exec"),
    ("php", "deserialization", "CWE-502", 9, "unserialize yaml_parse igbinary_unserialize"),
    ("php", "file_inclusion", "CWE-98", 9, "include include_once require require_once"),
    ("php", "path_traversal", "CWE-22", 8, "fopen file_get_contents readfile file unlink copy rename scandir"),
    ("php", "sql_injection", "CWE-89", 9, "mysqli_query mysql_query pg_query sqlite_query ->query ->exec ->prepare"),
    ("php", "ssrf", "CWE-918", 8, "curl_init curl_setopt fsockopen get_headers"),
    ("php", "xss", "CWE-79", 6, "print printf vprintf print_r"),
    ("php", "code_injection", "CWE-94", 10, "eval assert create_function call_user_func preg_replace"),
    ("php", "open_redirect", "CWE-601", 5, "header wp_redirect"),
    ("javascript", "command_injection", "CWE-78", 10, "exec execSync spawn spawnSync execFile fork"),
    ("javascript", "path_traversal", "CWE-22", 8, "readFile readFileSync createReadStream sendFile path.join unlink"),
    ("javascript", "sql_injection", "CWE-89", 9, ".query .raw sequelize.literal"),
    ("javascript", "ssrf", "CWE-918", 8, "axios axios.get axios.post fetch got needle http.get https.get"),
    ("javascript", "xss", "CWE-79", 6, "res.send res.write res.end document.write"),
    ("javascript", "code_injection", "CWE-95", 10, "eval Function setTimeout vm.runInNewContext vm.runInContext"),
    ("javascript", "open_redirect", "CWE-601", 5, "res.redirect res.location"),
    ("javascript", "deserialization", "CWE-502", 9, "unserialize yaml.load deserialize"),
    ("python", "command_injection", "CWE-78", 10,
     "os.system os.popen subprocess.run subprocess.call subprocess.Popen subprocess.check_output commands.getoutput"),
    ("python", "deserialization", "CWE-502", 9, "pickle.loads cPickle.loads marshal.loads yaml.load jsonpickle.decode dill.loads"),
    ("python", "path_traversal", "CWE-22", 8, "open send_file FileResponse os.remove os.path.join shutil.copy"),
    ("python", "sql_injection", "CWE-89", 9, ".execute .executemany .raw .extra"),
    ("python", "ssrf", "CWE-918", 8, "requests.get requests.post requests.request urlopen httpx.get urllib.request.urlopen"),
    ("python", "xss", "CWE-79", 6, "render_template_string mark_safe Markup HttpResponse"),
    ("python", "code_injection", "CWE-95", 10, "eval exec compile __import__"),
    ("python", "open_redirect", "CWE-601", 5, "redirect HttpResponseRedirect"),
    ("java", "command_injection", "CWE-78", 10, ".exec ProcessBuilder"),
    ("java", "sql_injection", "CWE-89", 9, ".executeQuery .executeUpdate .execute .prepareStatement .createQuery .createNativeQuery"),
    ("java", "path_traversal", "CWE-22", 8, "File FileInputStream FileReader Paths.get Files.readAllBytes"),
    ("java", "ssrf", "CWE-918", 8, "URL .openConnection HttpGet .getForObject .exchange"),
    ("java", "xss", "CWE-79", 6, ".println .print .write .append"),
    ("java", "open_redirect", "CWE-601", 5, ".sendRedirect ModelAndView"),
    ("java", "deserialization", "CWE-502", 9, "ObjectInputStream .fromXML XMLDecoder .readValue"),
    ("csharp", "os_command_injection", "CWE-78", 10, "Process.Start ProcessStartInfo"),
    ("csharp", "sql_injection", "CWE-89", 9, "SqlCommand ExecuteReader ExecuteNonQuery FromSqlRaw ExecuteSqlRaw"),
    ("csharp", "path_traversal", "CWE-22", 8, "File.ReadAllText File.Open FileStream Path.Combine"),
    ("csharp", "ssrf", "CWE-918", 8, "WebRequest.Create GetAsync DownloadString GetStringAsync"),
    ("csharp", "xss", "CWE-79", 6, "Response.Write Html.Raw"),
    ("csharp", "open_redirect", "CWE-601", 5, "Redirect Response.Redirect"),
    ("csharp", "deserialization", "CWE-502", 9, "Deserialize JsonConvert.DeserializeObject"),
]

# (language, vulnerability type, weakness, severity, name, regex): risky whatever they are fed.
RISKY = [
    ("php", "weak_crypto", "CWE-327", 5, "weak hash", r"\b(?:md5|sha1|crc32)\s*\("),
    ("php", "weak_crypto", "CWE-327", 6, "mcrypt", r"\bmcrypt_\w+\s*\("),
    ("php", "xxe", "CWE-611", 8, "entity substitution", r"\bLIBXML_(?:NOENT|DTDLOAD)\b"),
    ("php", "xxe", "CWE-611", 9, "entity loader on", r"\blibxml_disable_entity_loader\s*\(\s*false"),
    ("php", "xss", "CWE-79", 7, "echo of a request value", r"\becho\b[^;\n]*\$_(?:GET|POST|REQUEST|COOKIE)\b"),
    ("php", "information_disclosure", "CWE-209", 3, "phpinfo", r"\bphpinfo\s*\("),
    ("javascript", "weak_crypto", "CWE-327", 5, "weak hash", r"createHash\s*\(\s*['\"](?:md5|sha1)['\"]"),
    ("javascript", "weak_crypto", "CWE-327", 6, "key-less cipher", r"\bcreateCipher\s*\("),
    ("javascript", "xss", "CWE-79", 5, "raw markup", r"\bdangerouslySetInnerHTML\b|\.(?:inner|outer)HTML\s*\+?=(?!=)"),
    ("javascript", "improper_cert_validation", "CWE-295", 7, "certificates unchecked",
     r"rejectUnauthorized\s*:\s*false|NODE_TLS_REJECT_UNAUTHORIZED"),
    ("javascript", "cleartext_transmission", "CWE-319", 4, "plain http",
     r"\b(?:axios|fetch|request)[\w.]*\s*\(\s*['\"]http://(?!localhost|127\.)"),
    ("python", "command_injection", "CWE-78", 8, "shell=True", r"\bsubprocess\.\w+\s*\([^)\n]*shell\s*=\s*True"),
    ("python", "deserialization", "CWE-502", 7, "unsafe yaml", r"\byaml\.(?:unsafe_load|load\s*\((?![^)\n]*SafeLoader))"),
    ("python", "weak_crypto", "CWE-327", 5, "weak hash", r"\bhashlib\.(?:md5|sha1)\s*\("),
    ("python", "weak_crypto", "CWE-327", 6, "weak cipher", r"\b(?:DES3?|ARC4|Blowfish)\.new\s*\("),
    ("python", "xxe", "CWE-611", 7, "entities resolved", r"resolve_entities\s*=\s*True|\bxml\.sax\.make_parser\s*\("),
    ("python", "improper_cert_validation", "CWE-295", 7, "verify=False", r"\bverify\s*=\s*False\b|\b_create_unverified_context\b"),
    ("python", "sql_injection", "CWE-89", 8, "formatted SQL",
     r"\.execute\s*\(\s*(?:f['\"]|['\"][^'\"\n]*['\"]\s*(?:%|\+|\.format))"),
    ("java", "weak_crypto", "CWE-327", 5, "weak digest", r"MessageDigest\.getInstance\s*\(\s*\"(?:MD[245]|SHA-?1)\""),
    ("java", "weak_crypto", "CWE-327", 6, "weak cipher", r"Cipher\.getInstance\s*\(\s*\"(?:DES|RC4|[A-Za-z]+/ECB)"),
    ("java", "xxe", "CWE-611", 6, "XML parser factory",
     r"\b(?:DocumentBuilderFactory|SAXParserFactory|XMLInputFactory)\.new(?:Instance|Factory)\s*\("),
    ("java", "deserialization", "CWE-502", 8, "readObject", r"\.readObject\s*\(\s*\)"),
    ("java", "sql_injection", "CWE-89", 8, "concatenated SQL", r"\.execute(?:Query|Update)?\s*\(\s*\"[^\"\n]*\"\s*\+"),
    ("csharp", "deserialization", "CWE-502", 9, "binary formatter",
     r"\b(?:BinaryFormatter|NetDataContractSerializer|LosFormatter|SoapFormatter)\b"),
    ("csharp", "deserialization", "CWE-502", 8, "type names in JSON", r"TypeNameHandling\.(?:All|Auto|Objects|Arrays)"),
    ("csharp", "information_disclosure", "CWE-209", 3, "developer error page", r"\bUseDeveloperExceptionPage\s*\("),
    ("csharp", "information_disclosure", "CWE-209", 3, "exception sent", r"\bResponse\.Write(?:Async)?\s*\(\s*ex\b"),
    ("csharp", "sql_injection", "CWE-89", 8, "concatenated SQL", r"\bnew\s+SqlCommand\s*\(\s*\$?\"[^\"\n]*\"\s*\+"),
]


def _slug(text: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", text.lower()).strip("_")


def request_rule(language: str, kind: str, cwe: str, severity: int, call: str) -> Rule:
    """Rule for ``call`` with a request value in its argument list, on one line."""
    guard = "" if call[0] in ".-" else r"(?<![\w$])"
    # PHP writes include and require without parentheses as well.
    arguments = r"\b\s*[(\s][^;\n]*" if call.startswith(("include", "require")) else r"\s*\([^;\n]*"
    regex = guard + re.escape(call) + arguments + REQUEST_VALUE[language]
    name = f"{call.strip('.->')} with request value"
    return Rule(f"{language}_{kind}_{_slug(call)}", name, regex, kind, severity, language, cwe, CWE_NAMES[cwe])


def builtin_rules(language: str | None = None) -> list[Rule]:
    """All built-in rules, or those of one language."""
    rules = [request_rule(lang, kind, cwe, severity, call)
             for lang, kind, cwe, severity, calls in REQUEST_CALLS for call in calls.split()]
    rules += [Rule(f"{lang}_{kind}_{_slug(name)}", name, regex, kind, severity, lang, cwe, CWE_NAMES[cwe])
              for lang, kind, cwe, severity, name, regex in RISKY]
    return [rule for rule in rules if language is None or rule.language == language]
