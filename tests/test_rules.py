import re

import pytest
from pyspark.sql import functions as F

from codesieve.packs import REQUEST_VALUE, builtin_rules
from codesieve.sources.rules import Rule, required_texts, rules_frame, rules_of

SAMPLE = {"php": "$_GET['q']", "javascript": "req.query.q", "python": "request.args['q']",
          "java": 'getParameter("q")', "csharp": 'Request.Query["q"]'}

# (rule id, should match, snippet)
CASES = [
    ("php_weak_crypto_weak_hash", True, "$h = md5($password);"),
    ("php_weak_crypto_weak_hash", False, "$h = hash('sha256', $password);"),
    ("php_weak_crypto_mcrypt", True, "mcrypt_encrypt($c, $k, $d, $m)"),
    ("php_xxe_entity_substitution", True, "$doc->loadXML($x, LIBXML_NOENT);"),
    ("php_xxe_entity_substitution", False, "$doc->loadXML($x);"),
    ("php_xxe_entity_loader_on", True, "libxml_disable_entity_loader(false);"),
    ("php_xxe_entity_loader_on", False, "libxml_disable_entity_loader(true);"),
    ("php_xss_echo_of_a_request_value", True, "echo 'Hi ' . $_POST['name'];"),
    ("php_xss_echo_of_a_request_value", False, "echo htmlspecialchars($name);"),
    ("php_information_disclosure_phpinfo", True, "phpinfo();"),
    ("php_file_inclusion_include", True, "include $_GET['page'];"),
    ("php_file_inclusion_include", False, "include 'header.php';"),
    ("javascript_weak_crypto_weak_hash", True, "crypto.createHash('md5')"),
    ("javascript_weak_crypto_weak_hash", False, "crypto.createHash('sha512')"),
    ("javascript_xss_raw_markup", True, "el.innerHTML = name"),
    ("javascript_xss_raw_markup", False, "if (el.innerHTML == name) {}"),
    ("javascript_improper_cert_validation_certificates_unchecked", True, "{ rejectUnauthorized: false }"),
    ("javascript_cleartext_transmission_plain_http", True, "axios.get('http://api.example.test/x')"),
    ("javascript_cleartext_transmission_plain_http", False, "axios.get('http://localhost:8080/x')"),
    ("python_command_injection_shell_true", True, "subprocess.run(line, shell=True)"),
    ("python_command_injection_shell_true", False, "subprocess.run(['ls'])"),
    ("python_deserialization_unsafe_yaml", True, "yaml.load(text)"),
    ("python_deserialization_unsafe_yaml", False, "yaml.load(text, Loader=SafeLoader)"),
    ("python_weak_crypto_weak_cipher", True, "DES.new(key)"),
    ("python_xxe_entities_resolved", True, "XMLParser(resolve_entities=True)"),
    ("python_improper_cert_validation_verify_false", True, "get(url, verify=False)"),
    ("python_sql_injection_formatted_sql", True, "cur.execute(f\"SELECT {x}\")"),
    ("python_sql_injection_formatted_sql", True, "cur.execute('SELECT ' + x)"),
    ("python_sql_injection_formatted_sql", False, "cur.execute('SELECT 1', (x,))"),
    ("java_weak_crypto_weak_digest", True, 'MessageDigest.getInstance("SHA-1")'),
    ("java_weak_crypto_weak_digest", False, 'MessageDigest.getInstance("SHA-256")'),
    ("java_weak_crypto_weak_cipher", True, 'Cipher.getInstance("AES/ECB/PKCS5Padding")'),
    ("java_xxe_xml_parser_factory", True, "DocumentBuilderFactory.newInstance()"),
    ("java_deserialization_readobject", True, "Object o = in.readObject();"),
    ("java_sql_injection_concatenated_sql", True, 'st.executeQuery("SELECT * FROM t WHERE a=" + a)'),
    ("csharp_deserialization_binary_formatter", True, "new BinaryFormatter()"),
    ("csharp_deserialization_type_names_in_json", True, "TypeNameHandling = TypeNameHandling.All"),
    ("csharp_information_disclosure_developer_error_page", True, "app.UseDeveloperExceptionPage();"),
    ("csharp_sql_injection_concatenated_sql", True, 'new SqlCommand("SELECT " + x)'),
    ("csharp_sql_injection_concatenated_sql", False, 'new SqlCommand("SELECT 1", c)'),
]


def test_pack_covers_all_types_and_languages():
    rules = builtin_rules()
    assert len({r.id for r in rules}) == len(rules)
    assert {r.language for r in rules} == set(REQUEST_VALUE)
    assert len({r.vulnerability_type for r in rules}) == 15
    assert builtin_rules("java") and all(r.language == "java" for r in builtin_rules("java"))


def test_rules_match_in_spark(spark):
    """Hand-written cases, and for each call a request value (hit) and a constant (no hit)."""
    rules = {r.id: r for r in builtin_rules()}
    cases = list(CASES)
    for rule in rules.values():
        if "with request value" in rule.name:
            call = rule.name.removesuffix(" with request value")
            lead = "x->" if r"\-\>" in rule.regex or "->" in rule.regex else "x." if rule.regex.startswith(r"\.") else ""
            cases += [(rule.id, True, f"{lead}{call}({SAMPLE[rule.language]})"), (rule.id, False, f"{lead}{call}('constant')")]
    for language in SAMPLE:
        of_language = [(i, s) for i, (rid, _, s) in enumerate(cases) if rules[rid].language == language]
        frame = spark.createDataFrame(of_language, "i int, s string")
        ids = sorted({rid for rid, _, _ in cases if rules[rid].language == language})
        columns = [F.col("s").rlike(rules[rid].java_regex()).alias(f"r{n}") for n, rid in enumerate(ids)]
        for row in frame.select("i", "s", *columns).collect():
            rid, expected, snippet = cases[row["i"]]
            assert row[f"r{ids.index(rid)}"] == expected, (rid, snippet)
            groups, ignore_case = rules[rid].needles()
            text = snippet.lower() if ignore_case else snippet
            if expected:
                assert all(any(t in text for t in group) for group in groups), (rid, snippet)


@pytest.mark.parametrize("regex,groups", [
    (r"foo\s*\(", [{"foo"}]),
    (r"\b(?:exec|system)\s*\(", [{"exec", "system"}]),
    (r"a|b", [{"a", "b"}]),
    (r"(?:foo)?bar", [{"bar"}]),
    (r"foo*", [{"fo"}]),
    (r"x+", [{"x"}]),
    (r"[0-9]{3}", [set("0123456789")]),
    (r"\d\d", [set("0123456789")]),
    (r"[^a]b", [{"b"}]),
    (r".*", []),
    (r"(?:foo|.)", []),
    (r"", []),
    (r"one\ntwo", []),
    (r"(?!bad)good", [{"good"}]),
    (r"(?i:foo)bar", []),
])
def test_required_texts(regex, groups):
    assert [set(g) for g in required_texts(regex)[0]] == groups


def test_required_texts_ignore_case():
    assert required_texts("(?i)FooBar") == ((frozenset({"foobar"}),), True)
    assert required_texts("(?i)FooBar", unicode=True) == ((), False)
    assert required_texts("[") == ((), False)


def test_java_spelling():
    rule = Rule("a", "a", r"(?P<q>['\"]).*(?P=q)", "xss", 1)
    assert rule.java_regex() == r"""(?d)(['"]).*(?:\1)"""
    assert rule.java_regex(unicode=True).startswith("(?dU)")
    assert Rule("a", "a", "^x$", "xss", 1).java_regex(whole_text=True) == r"(?d)(?:^|(?<=\n))x(?=\n|\z)"


def test_rules_round_trip(spark):
    rules = sorted(builtin_rules("csharp"), key=lambda r: r.id)
    assert rules_of(rules_frame(spark, rules)) == rules


def test_builtin_regexes_are_valid_python():
    for rule in builtin_rules():
        re.compile(rule.regex)
