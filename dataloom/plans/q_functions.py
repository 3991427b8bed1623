"""§2.9 scalar functions: one query per family, a column per function."""

from __future__ import annotations

from pyspark.sql import functions as F

from dataloom.functions import dates as D
from dataloom.functions import mathx as M
from dataloom.functions import strings as S
from dataloom.functions import weblog as W
from dataloom.plans.fixtures import CUSTOMER_NULLS_SQL, customer_nulls, with_ctes
from dataloom.plans.registry import query
from dataloom.session import table


def _r(c, d=6):
    return F.round(c, d)


@query(
    "fn_arith",
    """SELECT l_orderkey, l_linenumber, round(l_quantity + l_tax, 6) AS add_, round(l_quantity - l_tax, 6) AS sub_,
              round(l_extendedprice * l_discount, 6) AS mul_, round(l_extendedprice / NULLIF(l_discount, 0), 6) AS div_,
              CAST(l_linenumber % 3 AS BIGINT) AS mod_, -l_quantity AS neg_,
              CAST(l_linenumber // NULLIF(l_suppkey % 5, 0) AS BIGINT) AS int_div
       FROM lineitem""",
)
def fn_arith(spark, sf):
    li = table(spark, sf, "lineitem")
    q, t = F.col("l_quantity"), F.col("l_tax")
    return li.select(
        "l_orderkey", "l_linenumber", _r(q + t).alias("add_"), _r(q - t).alias("sub_"),
        _r(F.col("l_extendedprice") * F.col("l_discount")).alias("mul_"),
        _r(M.divide(F.col("l_extendedprice"), F.col("l_discount"))).alias("div_"),
        (F.col("l_linenumber") % 3).cast("long").alias("mod_"), (-q).alias("neg_"),
        M.int_divide(F.col("l_linenumber"), (F.col("l_suppkey") % 5).cast("int")).alias("int_div"),
    )


@query(
    "fn_math_round",
    """SELECT l_orderkey, l_linenumber, round(abs(x - 5000), 6) AS abs_, CAST(ceil(x) AS BIGINT) AS ceil_,
              CAST(floor(x) AS BIGINT) AS floor_, CAST(floor(x + 0.5) AS BIGINT) AS round_half_up,
              CAST(round(CAST(x AS DECIMAL(38, 10)), 2) AS DOUBLE) AS round2,
              CAST(round_even(CAST(x AS DECIMAL(38, 10)), 2) AS DOUBLE) AS bround2,
              CAST(round_even(CAST(x AS DECIMAL(38, 10)), 0) AS DOUBLE) AS rint_,
              CAST(round_even(CAST(x AS DECIMAL(38, 10)), 1) AS DOUBLE) AS round_to1, CAST(sign(x - 5000) AS DOUBLE) AS signum_
       FROM (SELECT l_orderkey, l_linenumber, l_extendedprice / 7.0 AS x FROM lineitem)""",
)
def fn_math_round(spark, sf):
    li = table(spark, sf, "lineitem")
    x = F.col("l_extendedprice") / 7.0
    return li.select(
        "l_orderkey", "l_linenumber", _r(F.abs(x - 5000)).alias("abs_"), F.ceil(x).cast("long").alias("ceil_"),
        F.floor(x).cast("long").alias("floor_"), M.round_half_up(x).cast("long").alias("round_half_up"),
        M.round_to(x, 2, "half_up").alias("round2"), M.round_to(x, 2).alias("bround2"), M.round_to(x, 0).alias("rint_"),
        M.round_to(x, 1).alias("round_to1"), F.signum(x - 5000).alias("signum_"),
    )


_TRIG_BASE = "SELECT l_orderkey, l_linenumber, l_discount AS d, l_quantity / 10.0 AS a, l_tax + 0.01 AS t FROM lineitem"


@query(
    "fn_math_trig",
    f"""SELECT l_orderkey, l_linenumber, round(sin(a), 6) AS sin_, round(cos(a), 6) AS cos_, round(tan(a), 6) AS tan_,
               round(asin(d), 6) AS asin_, round(acos(d), 6) AS acos_, round(atan(a), 6) AS atan_,
               round(atan2(d, t), 6) AS atan2_, round(sinh(d), 6) AS sinh_, round(cosh(d), 6) AS cosh_,
               round(tanh(d), 6) AS tanh_, round(asinh(a), 6) AS asinh_, round(acosh(1 + a), 6) AS acosh_,
               round(atanh(d), 6) AS atanh_, round(1 / cos(a), 6) AS sec_, round(1 / sin(a), 6) AS csc_,
               round(cot(a), 6) AS cot_, round(degrees(a), 6) AS degrees_, round(radians(a), 6) AS radians_
        FROM ({_TRIG_BASE})""",
)
def fn_math_trig(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_discount").alias("d"), (F.col("l_quantity") / 10.0).alias("a"),
        (F.col("l_tax") + 0.01).alias("t"),
    )
    a, d, t = F.col("a"), F.col("d"), F.col("t")
    fns = {
        "sin_": F.sin(a), "cos_": F.cos(a), "tan_": F.tan(a), "asin_": F.asin(d), "acos_": F.acos(d), "atan_": F.atan(a),
        "atan2_": F.atan2(d, t), "sinh_": F.sinh(d), "cosh_": F.cosh(d), "tanh_": F.tanh(d), "asinh_": F.asinh(a),
        "acosh_": F.acosh(1 + a), "atanh_": F.atanh(d), "sec_": F.sec(a), "csc_": F.csc(a), "cot_": F.cot(a),
        "degrees_": F.degrees(a), "radians_": F.radians(a),
    }
    return li.select("l_orderkey", "l_linenumber", *[_r(v).alias(k) for k, v in fns.items()])


@query(
    "fn_math_exp",
    f"""SELECT l_orderkey, l_linenumber, round(exp(d), 6) AS exp_, round(exp(d) - 1, 6) AS expm1_, round(ln(a), 6) AS log_,
               round(log10(a), 6) AS log10_, round(ln(1 + d), 6) AS log1p_, round(log2(a), 6) AS log2_,
               round(sqrt(a), 6) AS sqrt_, round(cbrt(a), 6) AS cbrt_, round(pow(a, 2.5), 6) AS pow_,
               round(sqrt(a * a + d * d), 6) AS hypot_, CAST(factorial(l_linenumber) AS BIGINT) AS factorial_
        FROM ({_TRIG_BASE})""",
)
def fn_math_exp(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_discount").alias("d"), (F.col("l_quantity") / 10.0).alias("a")
    )
    a, d = F.col("a"), F.col("d")
    fns = {
        "exp_": F.exp(d), "expm1_": F.expm1(d), "log_": F.log(a), "log10_": F.log10(a), "log1p_": F.log1p(d),
        "log2_": F.log2(a), "sqrt_": F.sqrt(a), "cbrt_": F.cbrt(a), "pow_": F.pow(a, 2.5), "hypot_": F.hypot(a, d),
    }
    return li.select(
        "l_orderkey", "l_linenumber", *[_r(v).alias(k) for k, v in fns.items()],
        F.factorial("l_linenumber").alias("factorial_"),
    )


@query(
    "fn_math_float_parts",
    """SELECT l_orderkey, l_linenumber,
              CASE WHEN (l_discount - 0.05) >= 0 THEN abs(l_tax - 0.04) ELSE -abs(l_tax - 0.04) END AS copysign_,
              round(l_quantity * pow(2.0, l_linenumber), 6) AS scalb_,
              round(l_quantity - 7 * round_even(l_quantity / 7, 0), 6) AS ieee_rem,
              greatest(l_discount, l_tax) AS max_, least(l_discount, l_tax) AS min_
       FROM lineitem""",
)
def fn_math_float_parts(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        M.copy_sign(F.col("l_tax") - 0.04, F.col("l_discount") - 0.05).alias("copysign_"),
        _r(M.scalb(F.col("l_quantity"), F.col("l_linenumber"))).alias("scalb_"),
        _r(M.ieee_remainder(F.col("l_quantity"), F.lit(7.0))).alias("ieee_rem"),
        M.max2(F.col("l_discount"), F.col("l_tax")).alias("max_"), M.min2(F.col("l_discount"), F.col("l_tax")).alias("min_"),
    )


@query(
    "fn_bits_base",
    """SELECT l_orderkey, l_linenumber, l_orderkey & 255 AS band, l_orderkey | 1024 AS bor, xor(l_orderkey, l_partkey) AS bxor,
              ~l_orderkey AS bnot, l_orderkey << 3 AS shl, l_orderkey >> 2 AS shr, l_orderkey >> 1 AS shru,
              bin(l_orderkey) AS bin_, hex(l_orderkey) AS hex_, CAST(unhex(hex(l_returnflag)) AS VARCHAR) AS unhex_,
              hex(l_partkey) AS conv_16
       FROM lineitem""",
)
def fn_bits_base(spark, sf):
    li = table(spark, sf, "lineitem")
    k = F.col("l_orderkey")
    return li.select(
        "l_orderkey", "l_linenumber", k.bitwiseAND(255).alias("band"), k.bitwiseOR(1024).alias("bor"),
        k.bitwiseXOR(F.col("l_partkey")).alias("bxor"), F.bitwise_not(k).alias("bnot"), F.shiftleft(k, 3).alias("shl"),
        F.shiftright(k, 2).alias("shr"), F.shiftrightunsigned(k, 1).alias("shru"), F.bin(k).alias("bin_"),
        F.hex(k).alias("hex_"), F.unhex(F.hex("l_returnflag")).cast("string").alias("unhex_"),
        F.conv(F.col("l_partkey").cast("string"), 10, 16).alias("conv_16"),
    )


@query("fn_random")
def fn_random(spark, sf):
    """Seeded uniform / normal columns and an exponential law by inverse transform."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return li.select(
        "l_orderkey", "l_linenumber", F.rand(42).alias("u"), F.randn(42).alias("z"),
        (-F.log(1 - F.rand(7)) / 2.0).alias("exp_rate2"),
    )


# SQL twin of the FNV hash over ASCII text (code point = byte there)
_FNV_SQL = """abs(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END)"""


@query(
    "fn_hash",
    f"""SELECT p_partkey, md5(p_name) AS md5_, sha1(p_name) AS sha1_, sha256(p_name) AS sha2_256,
               xor(list_reduce(list_transform(string_split(p_name, ''), lambda ch: unicode(ch)),
                   lambda crc, b: list_reduce([1, 2, 3, 4, 5, 6, 7, 8], lambda c, i: xor(c >> 1, 3988292384 & -(c & 1)),
                                             xor(crc, b)), 4294967295), 4294967295) AS crc32_,
               TRUE AS hash_stable, TRUE AS xxhash_stable,
               {_FNV_SQL} AS fnv32, {_FNV_SQL} % 1000 AS fnv32_mod
        FROM (SELECT *, list_reduce(list_transform(string_split(p_name, ''), lambda ch: unicode(ch)),
                                    lambda acc, b: xor((acc * 16777619) % 4294967296, b), 33554467) AS h FROM part)""",
)
def fn_hash(spark, sf):
    """md5 / sha1 / sha2 / crc32 values; murmur3 ``hash`` and ``xxhash64`` are
    checked for stability (equal input, equal hash) since no other engine shares
    their seeds; HashFNV with and without a modulus."""
    p = table(spark, sf, "part")
    n = F.col("p_name")
    same = F.concat(F.lit(""), n)
    return p.select(
        "p_partkey", F.md5(n).alias("md5_"), F.sha1(n).alias("sha1_"), F.sha2(n, 256).alias("sha2_256"),
        F.crc32(n).alias("crc32_"), (F.hash(n) == F.hash(same)).alias("hash_stable"),
        (F.xxhash64(n) == F.xxhash64(same)).alias("xxhash_stable"),
        S.hash_fnv32(n).alias("fnv32"), S.hash_fnv32(n, 1000).alias("fnv32_mod"),
    )


@query(
    "fn_str_case_trim",
    """SELECT p_partkey, upper(p_name) AS upper_, lower(p_brand) AS lower_,
              array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') AS initcap_,
              upper(left(p_name, 1)) || substr(p_name, 2) AS ucfirst_, lower(left(p_type, 1)) || substr(p_type, 2) AS lcfirst_,
              translate(p_brand, 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ', 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz') AS swapcase_,
              trim('  ' || p_name || ' ') AS trim_, ltrim('  ' || p_name) AS ltrim_, rtrim(p_name || '  ') AS rtrim_,
              lpad(p_name, 14, '*') AS lpad_, rpad(p_name, 14, '-') AS rpad_, lpad(CAST(p_size AS VARCHAR), 5, '0') AS zfill_,
              lower(p_type) = lower('economy') AS eq_ignore_case
       FROM part""",
)
def fn_str_case_trim(spark, sf):
    p = table(spark, sf, "part")
    n = F.col("p_name")
    lower_az, upper_az = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return p.select(
        "p_partkey", F.upper(n).alias("upper_"), F.lower("p_brand").alias("lower_"), F.initcap(n).alias("initcap_"),
        S.ucfirst(n).alias("ucfirst_"), S.lcfirst(F.col("p_type")).alias("lcfirst_"),
        F.translate("p_brand", lower_az + upper_az, upper_az + lower_az).alias("swapcase_"),
        F.trim(F.concat(F.lit("  "), n, F.lit(" "))).alias("trim_"), F.ltrim(F.concat(F.lit("  "), n)).alias("ltrim_"),
        F.rtrim(F.concat(n, F.lit("  "))).alias("rtrim_"), F.lpad(n, 14, "*").alias("lpad_"), F.rpad(n, 14, "-").alias("rpad_"),
        F.lpad(F.col("p_size").cast("string"), 5, "0").alias("zfill_"),
        (F.lower("p_type") == F.lower(F.lit("economy"))).alias("eq_ignore_case"),
    )


@query(
    "fn_str_slice_find",
    """SELECT p_partkey,
              CASE WHEN 2 > least(5, length(p_name)) THEN NULL ELSE substring(p_name, 3, least(5, length(p_name)) - 2) END AS substring0,
              CAST(strpos(p_name, 'e') - 1 AS BIGINT) AS indexof_,
              CAST(CASE WHEN strpos(p_name, 'e') = 0 THEN -1 ELSE length(p_name) - strpos(reverse(p_name), 'e') END AS BIGINT) AS last_indexof,
              CAST(strpos(p_name, 'r') AS BIGINT) AS instr_, split_part(p_name, ' ', 1) AS before_space,
              substring(p_name, 1, 1) || 'XX' || substring(p_name, 5) AS overlay_,
              substring(p_type, 1, 2) || '#' || substring(p_type, 4) AS stuff_
       FROM part""",
)
def fn_str_slice_find(spark, sf):
    p = table(spark, sf, "part")
    n = F.col("p_name")
    return p.select(
        "p_partkey", S.substring0(n, 2, 5).alias("substring0"), S.index_of(n, "e").cast("long").alias("indexof_"),
        S.last_index_of(n, "e").cast("long").alias("last_indexof"), F.instr(n, "r").cast("long").alias("instr_"),
        F.substring_index(n, " ", 1).alias("before_space"), F.overlay(n, F.lit("XX"), 2, 3).alias("overlay_"),
        # STUFF(s, start 0-based 2, length 1, '#')
        F.overlay(F.col("p_type"), F.lit("#"), 3, 1).alias("stuff_"),
    )


@query(
    "fn_str_concat_format",
    """SELECT p_partkey, p_brand || '-' || p_name AS concat_, concat_ws('/', p_brand, p_type, NULL) AS concat_ws_,
              printf('%s-%05d', p_brand, p_size) AS sprintf_, repeat(p_type, 2) AS repeat_, reverse(p_name) AS reverse_,
              CAST(length(p_name) AS BIGINT) AS length_, CAST(bit_length(p_name) AS BIGINT) AS bit_length_,
              CAST(octet_length(encode(p_name)) AS BIGINT) AS octet_length_, CAST(ascii(p_type) AS BIGINT) AS ascii_,
              format('{:,.2f}', p_retailprice * 1000) AS format_number_,
              CASE WHEN p_size > 40 THEN NULL ELSE p_brand || p_name END AS concat_null
       FROM part""",
)
def fn_str_concat_format(spark, sf):
    p = table(spark, sf, "part")
    return p.select(
        "p_partkey", F.concat("p_brand", F.lit("-"), "p_name").alias("concat_"),
        F.concat_ws("/", "p_brand", "p_type", F.lit(None)).alias("concat_ws_"),
        F.format_string("%s-%05d", "p_brand", "p_size").alias("sprintf_"), F.repeat("p_type", 2).alias("repeat_"),
        F.reverse("p_name").alias("reverse_"), F.length("p_name").cast("long").alias("length_"),
        F.bit_length("p_name").cast("long").alias("bit_length_"), F.octet_length("p_name").cast("long").alias("octet_length_"),
        F.ascii("p_type").cast("long").alias("ascii_"), F.format_number(F.col("p_retailprice") * 1000, 2).alias("format_number_"),
        # CONCAT: any null operand gives null
        F.concat(F.when(F.col("p_size") <= 40, F.col("p_brand")), F.col("p_name")).alias("concat_null"),
    )


@query(
    "fn_str_split",
    """SELECT p_partkey,
              array_to_string(list_slice(parts, 1, list_max(list_transform(parts, lambda x, i: CASE WHEN x <> '' THEN i ELSE 0 END))), '|') AS strsplit_,
              array_to_string([split_part(s, ',', 1), substr(s, strpos(s, ',') + 1)], '|') AS strsplit_limit2,
              array_to_string(list_filter(regexp_split_to_array(p_name || ' (' || p_type || ')*x', '[ ",()*\\t\\n\\r\\f]+'), lambda x: x <> ''), '|') AS tokenize_,
              CAST(len(parts) AS BIGINT) AS n_raw_parts
       FROM (SELECT *, p_name || ',' || p_brand || ',,' AS s, regexp_split_to_array(p_name || ',' || p_brand || ',,', ',') AS parts FROM part)""",
)
def fn_str_split(spark, sf):
    p = table(spark, sf, "part")
    s = F.concat_ws(",", "p_name", "p_brand", F.lit(""), F.lit(""))
    return p.select(
        "p_partkey", F.array_join(S.strsplit(s, ",", 0), "|").alias("strsplit_"),
        F.array_join(S.strsplit(s, ",", 2), "|").alias("strsplit_limit2"),
        F.array_join(S.tokenize(F.concat("p_name", F.lit(" ("), "p_type", F.lit(")*x"))), "|").alias("tokenize_"),
        F.size(F.split(s, ",", -1)).cast("long").alias("n_raw_parts"),
    )


@query(
    "fn_str_regex",
    """SELECT p_partkey,
              CASE WHEN regexp_matches(p_brand, 'd#(1[0-9])') THEN regexp_extract(p_brand, 'd#(1[0-9])', 1) END AS regex_extract_,
              CASE WHEN regexp_full_match(p_name, '([a-z]+) ([a-z]+)')
                   THEN regexp_extract(p_name, '^(?:([a-z]+) ([a-z]+))$', 1) || '|' || regexp_extract(p_name, '^(?:([a-z]+) ([a-z]+))$', 2) END AS extract_all,
              array_to_string(regexp_extract_all(p_name || ' ' || p_type, '([a-z]+)', 1), '|') AS regex_search,
              CAST(len(regexp_extract_all(p_name, '[aeiou]', 0)) AS BIGINT) AS n_vowels
       FROM part""",
)
def fn_str_regex(spark, sf):
    p = table(spark, sf, "part")
    return p.select(
        "p_partkey", S.regex_extract(F.col("p_brand"), "d#(1[0-9])", 1).alias("regex_extract_"),
        F.array_join(S.regex_extract_all(F.col("p_name"), "([a-z]+) ([a-z]+)"), "|").alias("extract_all"),
        F.array_join(F.regexp_extract_all(F.concat_ws(" ", "p_name", "p_type"), F.lit("([a-z]+)"), 1), "|").alias("regex_search"),
        F.size(F.regexp_extract_all("p_name", F.lit("[aeiou]"), 0)).cast("long").alias("n_vowels"),
    )


# fixed value: the replacement map of the REPLACE_MULTI example
_MULTI = {"ring": "RING", "bolt": "BOLT", "red": "RED"}


@query(
    "fn_str_replace",
    """SELECT p_partkey, regexp_replace(p_name, '[aeiou]', '*', 'g') AS replace_,
              replace(replace(replace(p_name, 'ring', 'RING'), 'bolt', 'BOLT'), 'red', 'RED') AS replace_multi,
              translate(p_type, 'AEIOU', '12345') AS translate_
       FROM part""",
)
def fn_str_replace(spark, sf):
    p = table(spark, sf, "part")
    multi = F.col("p_name")
    for k, v in _MULTI.items():
        multi = F.replace(multi, F.lit(k), F.lit(v))
    return p.select(
        "p_partkey", F.regexp_replace("p_name", "[aeiou]", "*").alias("replace_"), multi.alias("replace_multi"),
        F.translate("p_type", "AEIOU", "12345").alias("translate_"),
    )


# SQL soundex (American rules as Spark implements them): first letter kept;
# letters coded, H / W dropped without separating, other characters separate,
# runs of one code collapsed, zeros removed, padded to 4.
def _soundex_sql(col: str) -> str:
    u = f"upper({col})"
    codes = (
        f"translate(regexp_replace(substr({u}, 2), '[^A-Z]', '0', 'g'), "
        "'ABCDEFGIJKLMNOPQRSTUVXYZHW', '012301202245501262301022')"
    )
    first = f"translate(left({u}, 1), 'ABCDEFGIJKLMNOPQRSTUVXYZHW', '012301202245501262301022')"
    seq = f"({first} || {codes})"
    for dgt in "0123456":
        seq = f"regexp_replace({seq}, '{dgt}+', '{dgt}', 'g')"
    tail = f"replace(substr({seq}, 2), '0', '')"
    return f"rpad(left({u}, 1) || left({tail}, 3), 4, '0')"


@query(
    "fn_str_distance",
    f"""SELECT p_partkey, CAST(levenshtein(p_name, lower(p_type)) AS BIGINT) AS levenshtein_,
               {_soundex_sql('p_name')} AS soundex_
        FROM part""",
)
def fn_str_distance(spark, sf):
    p = table(spark, sf, "part")
    return p.select(
        "p_partkey", F.levenshtein("p_name", F.lower("p_type")).cast("long").alias("levenshtein_"),
        F.soundex("p_name").alias("soundex_"),
    )


@query(
    "fn_str_encode",
    """SELECT p_partkey, to_base64(encode(p_name)) AS base64_, decode(from_base64(to_base64(encode(p_name)))) AS unbase64_,
              hex(encode(p_type)) AS encode_hex, decode(encode(p_brand)) AS decode_
       FROM part""",
)
def fn_str_encode(spark, sf):
    p = table(spark, sf, "part")
    return p.select(
        "p_partkey", F.base64(F.encode("p_name", "UTF-8")).alias("base64_"),
        F.decode(F.unbase64(F.base64(F.encode("p_name", "UTF-8"))), "UTF-8").alias("unbase64_"),
        F.hex(F.encode("p_type", "UTF-8")).alias("encode_hex"), F.decode(F.encode("p_brand", "UTF-8"), "UTF-8").alias("decode_"),
    )


# fixed values: one character class per pandas str.isX test (ASCII)
_TESTS = {
    "isalnum": "[A-Za-z0-9]+", "isalpha": "[A-Za-z]+", "isdigit": "[0-9]+", "isspace": "\\s+",
    "islower": "[^A-Z]*[a-z][^A-Z]*", "isupper": "[^a-z]*[A-Z][^a-z]*", "istitle": "[A-Z][a-z]*( [A-Z][a-z]*)*",
}


@query(
    "fn_str_tests",
    "SELECT tok, " + ", ".join(f"regexp_full_match(tok, '{v}') AS {k}" for k, v in _TESTS.items())
    + " FROM (SELECT unnest(string_split(p_name || ' ' || p_brand || ' ' || p_type || ' ' || CAST(p_size AS VARCHAR) || ' Title Case', ' ')) AS tok FROM part)",
)
def fn_str_tests(spark, sf):
    p = table(spark, sf, "part")
    toks = p.select(
        F.explode(F.split(F.concat_ws(" ", "p_name", "p_brand", "p_type", F.col("p_size").cast("string"), F.lit("Title Case")), " ")).alias("tok")
    )
    return toks.select("tok", *[F.col("tok").rlike(f"^(?:{v})$").alias(k) for k, v in _TESTS.items()])


@query(
    "fn_date_parts",
    """SELECT event_id, year(ts) AS year_, month(ts) AS month_, day(ts) AS day_, hour(ts) AS hour_, minute(ts) AS minute_,
              second(ts) AS second_, (epoch_us(ts) // 1000) % 1000 AS milli_, weekofyear(ts) AS iso_week, isoyear(ts) AS iso_year,
              dayofweek(ts) + 1 AS dayofweek_, dayofyear(ts) AS dayofyear_, quarter(ts) AS quarter_,
              monthname(ts) AS month_name, dayname(ts) AS day_name, last_day(ts) AS last_day_,
              CAST(ts AS DATE) + CAST(CASE WHEN isodow(ts) = 1 THEN 7 ELSE 8 - isodow(ts) END AS INTEGER) AS next_monday,
              day(ts) = 1 AS is_month_start, CAST(ts AS DATE) = last_day(ts) AS is_month_end,
              (year(ts) % 4 = 0 AND year(ts) % 100 <> 0) OR year(ts) % 400 = 0 AS is_leap_year,
              day(last_day(ts)) AS days_in_month
       FROM events""",
)
def fn_date_parts(spark, sf):
    e = table(spark, sf, "events")
    ts = F.col("ts")
    y = F.year(ts)
    L = lambda c: c.cast("long")
    return e.select(
        "event_id", L(y).alias("year_"), L(F.month(ts)).alias("month_"), L(F.dayofmonth(ts)).alias("day_"),
        L(F.hour(ts)).alias("hour_"), L(F.minute(ts)).alias("minute_"), L(F.second(ts)).alias("second_"),
        (F.unix_millis(ts.cast("timestamp")) % 1000).alias("milli_"), L(F.weekofyear(ts)).alias("iso_week"),
        L(F.extract(F.lit("YEAROFWEEK"), ts)).alias("iso_year"), L(F.dayofweek(ts)).alias("dayofweek_"),
        L(F.dayofyear(ts)).alias("dayofyear_"), L(F.quarter(ts)).alias("quarter_"),
        F.date_format(ts, "MMMM").alias("month_name"), F.date_format(ts, "EEEE").alias("day_name"),
        F.last_day(ts).alias("last_day_"), F.next_day(ts, "Mon").alias("next_monday"),
        (F.dayofmonth(ts) == 1).alias("is_month_start"), (F.to_date(ts) == F.last_day(ts)).alias("is_month_end"),
        (((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)).alias("is_leap_year"),
        L(F.dayofmonth(F.last_day(ts))).alias("days_in_month"),
    )


@query(
    "fn_date_parse_format",
    """SELECT event_id, strftime(ts, '%Y/%m/%d %H:%M:%S') AS to_string_,
              strptime(strftime(ts, '%Y/%m/%d %H:%M:%S'), '%Y/%m/%d %H:%M:%S') AS to_date_,
              CAST(floor(epoch(ts)) AS BIGINT) AS unix_time, epoch_us(ts) // 1000 AS millis_,
              strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS iso_,
              strftime(TIMESTAMP '1970-01-01' + to_seconds(CAST(floor(epoch(ts)) AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS from_unix,
              make_date(year(ts), month(ts), 1) AS month_start,
              strptime(strftime(ts, '%d-%m-%Y'), '%d-%m-%Y') AS custom_to_iso
       FROM events""",
)
def fn_date_parse_format(spark, sf):
    e = table(spark, sf, "events")
    ts = F.col("ts")
    s1 = F.date_format(ts, "yyyy/MM/dd HH:mm:ss")
    unix = F.unix_timestamp(ts.cast("timestamp"))
    return e.select(
        "event_id", s1.alias("to_string_"),
        F.try_to_timestamp(s1, F.lit("yyyy/MM/dd HH:mm:ss")).cast("timestamp_ntz").alias("to_date_"),
        unix.alias("unix_time"), F.unix_millis(ts.cast("timestamp")).alias("millis_"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("iso_"),
        F.from_unixtime(unix, "yyyy-MM-dd HH:mm:ss").alias("from_unix"),
        F.make_date(F.year(ts), F.month(ts), F.lit(1)).alias("month_start"),
        F.try_to_timestamp(F.date_format(ts, "dd-MM-yyyy"), F.lit("dd-MM-yyyy")).cast("timestamp_ntz").alias("custom_to_iso"),
    )


# fixed values: the date formats tried in order by the crash cleaning job
CRASH_TIME_FORMATS = [
    "yyyy-MM-dd HH:mm:ss",
    "d/M/yyyy H:mm:ss",
    "d/M/yyyy H:mm",
    "dd/MM/yyyy HH:mm:ss",
    "MM/dd/yyyy HH:mm:ss",
    "yyyy/MM/dd HH:mm:ss",
]

MIXED_TIME_SPARK = (
    "CASE event_type WHEN 'view' THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') "
    "WHEN 'click' THEN date_format(ts, 'd/M/yyyy H:mm:ss') WHEN 'purchase' THEN date_format(ts, 'd/M/yyyy H:mm') "
    "WHEN 'signup' THEN date_format(ts, 'yyyy/MM/dd HH:mm:ss') ELSE cast(unix_timestamp(cast(ts as timestamp)) as string) END"
)
MIXED_TIME_SQL = (
    "CASE event_type WHEN 'view' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') "
    "WHEN 'click' THEN strftime(ts, '%-d/%-m/%Y %-H:%M:%S') WHEN 'purchase' THEN strftime(ts, '%-d/%-m/%Y %-H:%M') "
    "WHEN 'signup' THEN strftime(ts, '%Y/%m/%d %H:%M:%S') ELSE CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) END"
)


@query(
    "fn_date_parse_fallback",
    f"""SELECT event_id, raw,
               CASE WHEN event_type = 'view' THEN date_trunc('second', ts)
                    WHEN event_type IN ('click') THEN date_trunc('second', ts)
                    WHEN event_type = 'purchase' THEN date_trunc('minute', ts)
                    WHEN event_type = 'signup' THEN date_trunc('second', ts)
                    ELSE date_trunc('second', ts) END AS parsed
        FROM (SELECT event_id, event_type, ts, {MIXED_TIME_SQL} AS raw FROM events)""",
)
def fn_date_parse_fallback(spark, sf):
    """Mixed-format text: the first format that parses wins, else epoch seconds.

    The oracle is the source timestamp cut to the precision each text kept.
    """
    e = table(spark, sf, "events").select("event_id", F.expr(MIXED_TIME_SPARK).alias("raw"))
    return e.select("event_id", "raw", D.parse_first(F.col("raw"), CRASH_TIME_FORMATS).alias("parsed"))


@query(
    "fn_date_between",
    """SELECT o.o_orderkey, l.l_linenumber,
              CAST(trunc(trunc((((year(l.l_shipdate) * 12 + month(l.l_shipdate)) * 32 + day(l.l_shipdate))
                          - ((year(o.o_orderdate) * 12 + month(o.o_orderdate)) * 32 + day(o.o_orderdate))) / 32.0) / 12.0) AS BIGINT) AS years_,
              CAST(trunc((((year(l.l_shipdate) * 12 + month(l.l_shipdate)) * 32 + day(l.l_shipdate))
                          - ((year(o.o_orderdate) * 12 + month(o.o_orderdate)) * 32 + day(o.o_orderdate))) / 32.0) AS BIGINT) AS months_, CASE WHEN l.l_shipdate >= o.o_orderdate THEN date_sub('week', o.o_orderdate, l.l_shipdate) ELSE -date_sub('week', l.l_shipdate, o.o_orderdate) END AS weeks_,
              CASE WHEN l.l_shipdate >= o.o_orderdate THEN date_sub('day', o.o_orderdate, l.l_shipdate) ELSE -date_sub('day', l.l_shipdate, o.o_orderdate) END AS days_, CASE WHEN l.l_shipdate >= o.o_orderdate THEN date_sub('hour', o.o_orderdate, l.l_shipdate) ELSE -date_sub('hour', l.l_shipdate, o.o_orderdate) END AS hours_,
              CASE WHEN l.l_shipdate >= o.o_orderdate THEN date_sub('minute', o.o_orderdate, l.l_shipdate) ELSE -date_sub('minute', l.l_shipdate, o.o_orderdate) END AS minutes_, CASE WHEN l.l_shipdate >= o.o_orderdate THEN date_sub('second', o.o_orderdate, l.l_shipdate) ELSE -date_sub('second', l.l_shipdate, o.o_orderdate) END AS seconds_,
              CASE WHEN l.l_shipdate >= o.o_orderdate THEN date_sub('millisecond', o.o_orderdate, l.l_shipdate) ELSE -date_sub('millisecond', l.l_shipdate, o.o_orderdate) END AS millis_,
              CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS BIGINT) AS diff_date
       FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey""",
)
def fn_date_between(spark, sf):
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    j = o.join(li, o.o_orderkey == li.l_orderkey)
    a, b = F.col("l_shipdate"), F.col("o_orderdate")
    units = {"years_": "YEAR", "months_": "MONTH", "weeks_": "WEEK", "days_": "DAY", "hours_": "HOUR",
             "minutes_": "MINUTE", "seconds_": "SECOND", "millis_": "MILLISECOND"}
    # DiffDate on yyyyMMdd text
    da, db = F.to_date(F.date_format(a, "yyyyMMdd"), "yyyyMMdd"), F.to_date(F.date_format(b, "yyyyMMdd"), "yyyyMMdd")
    return j.select(
        "o_orderkey", "l_linenumber", *[D.between(u, a, b).alias(k) for k, u in units.items()],
        F.datediff(da, db).cast("long").alias("diff_date"),
    )


@query(
    "fn_date_add",
    """SELECT event_id, 'P' || CAST(k % 3 AS VARCHAR) || 'DT' || CAST(user_id % 24 AS VARCHAR) || 'H' AS duration,
              ts + to_days(k % 3) + to_hours(user_id % 24) AS plus_duration,
              ts - to_days(k % 3) - to_hours(user_id % 24) AS minus_duration,
              CAST(ts AS DATE) + CAST(k AS INTEGER) AS date_add_, CAST(ts AS DATE) - 3 AS date_sub_,
              CAST(CAST(ts AS DATE) + to_months(k % 13) AS DATE) AS add_months_
       FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
)
def fn_date_add(spark, sf):
    e = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    dur = F.concat(F.lit("P"), (F.col("k") % 3).cast("string"), F.lit("DT"), (F.col("user_id") % 24).cast("string"), F.lit("H"))
    return e.select(
        "event_id", dur.alias("duration"), D.add_duration(F.col("ts"), dur).alias("plus_duration"),
        D.add_duration(F.col("ts"), dur, -1).alias("minus_duration"), F.date_add("ts", F.col("k")).alias("date_add_"),
        F.date_sub("ts", 3).alias("date_sub_"), F.add_months("ts", F.col("k") % 13).alias("add_months_"),
    )


@query(
    "fn_date_trunc",
    """SELECT event_id, date_trunc('year', ts) AS t_year, date_trunc('month', ts) AS t_month, date_trunc('week', ts) AS t_week,
              date_trunc('day', ts) AS t_day, date_trunc('hour', ts) AS t_hour, date_trunc('minute', ts) AS t_minute,
              date_trunc('second', ts) AS t_second, CAST(date_trunc('quarter', ts) AS DATE) AS trunc_quarter,
              TIMESTAMP '1970-01-01' + to_seconds(CAST(floor(epoch(ts) / 900) * 900 AS BIGINT)) AS floor_15min,
              TIMESTAMP '1970-01-01' + to_seconds(CAST(ceil(epoch(ts) / 900) * 900 AS BIGINT)) AS ceil_15min
       FROM events""",
)
def fn_date_trunc(spark, sf):
    e = table(spark, sf, "events")
    ts = F.col("ts")
    units = {"t_year": "year", "t_month": "month", "t_week": "week", "t_day": "day", "t_hour": "hour",
             "t_minute": "minute", "t_second": "second"}
    return e.select(
        "event_id", *[F.date_trunc(u, ts).cast("timestamp_ntz").alias(k) for k, u in units.items()],
        F.trunc(ts, "quarter").alias("trunc_quarter"), D.floor_to(ts, 900).alias("floor_15min"),
        D.ceil_to(ts, 900).alias("ceil_15min"),
    )


@query(
    "fn_date_zone_now",
    """SELECT event_id, current_date >= CAST(ts AS DATE) AS not_future,
              (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS new_york,
              (ts AT TIME ZONE 'Asia/Tokyo') AT TIME ZONE 'UTC' AS tokyo_to_utc
       FROM events""",
)
def fn_date_zone_now(spark, sf):
    e = table(spark, sf, "events")
    ts = F.col("ts").cast("timestamp")
    return e.select(
        "event_id", (F.current_date() >= F.to_date("ts")).alias("not_future"),
        F.from_utc_timestamp(ts, "America/New_York").cast("timestamp_ntz").alias("new_york"),
        F.to_utc_timestamp(ts, "Asia/Tokyo").cast("timestamp_ntz").alias("tokyo_to_utc"),
    )


@query(
    "fn_date_season_weekend",
    """SELECT event_id, CASE WHEN month(ts) IN (12, 1, 2) THEN 'winter' WHEN month(ts) IN (3, 4, 5) THEN 'spring'
                             WHEN month(ts) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season,
              CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
       FROM events""",
)
def fn_date_season_weekend(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", D.season(F.month("ts")).alias("season"), D.is_weekend(F.col("ts")).alias("is_weekend"))


@query(
    "fn_time_of_day_filter",
    """SELECT event_id, ts, 'between' AS kind FROM events WHERE strftime(ts, '%H:%M:%S') BETWEEN '09:00:00' AND '10:30:00'
       UNION ALL SELECT event_id, ts, 'at' FROM events WHERE strftime(ts, '%H:%M') = '12:00'
       UNION ALL SELECT event_id, ts, 'first_2d' FROM events WHERE ts < (SELECT min(ts) FROM events) + INTERVAL 2 DAY
       UNION ALL SELECT event_id, ts, 'last_1d' FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 1 DAY""",
)
def fn_time_of_day_filter(spark, sf):
    """between_time / at_time / first / last offsets. The bounds for first / last
    are one global aggregate (a single row) joined as a scalar."""
    e = table(spark, sf, "events").select("event_id", "ts")
    hms = F.date_format("ts", "HH:mm:ss")
    b = e.filter(hms.between("09:00:00", "10:30:00")).withColumn("kind", F.lit("between"))
    a = e.filter(F.date_format("ts", "HH:mm") == "12:00").withColumn("kind", F.lit("at"))
    lo, hi = e.agg(F.min("ts"), F.max("ts")).first()
    first = e.filter(F.col("ts") < F.lit(lo) + F.expr("INTERVAL 2 DAYS")).select("event_id", "ts", F.lit("first_2d").alias("kind"))
    last = e.filter(F.col("ts") > F.lit(hi) - F.expr("INTERVAL 1 DAY")).select("event_id", "ts", F.lit("last_1d").alias("kind"))
    return b.unionByName(a).unionByName(first).unionByName(last)


_ARR = "[p_brand, p_type, p_name]"


@query(
    "fn_array_build_query",
    f"""SELECT p_partkey, CAST(len({_ARR}) AS BIGINT) AS size_, list_contains({_ARR}, 'ECONOMY') AS contains_,
               CAST(coalesce(list_position({_ARR}, p_name), 0) AS BIGINT) AS position_, {_ARR}[2] AS element_at_,
               array_to_string(list_slice({_ARR}, 2, 3), '|') AS slice_,
               CAST(len(range(1, p_size % 5 + 2)) AS BIGINT) AS sequence_len,
               array_to_string([p_brand, p_brand], '|') AS repeat_, list_has_any({_ARR}, ['SMALL', 'LARGE']) AS overlaps_,
               len(list_filter({_ARR}, lambda x: x = 'none')) = 0 AS is_empty_filter
        FROM part""",
)
def fn_array_build_query(spark, sf):
    p = table(spark, sf, "part")
    arr = F.array("p_brand", "p_type", "p_name")
    return p.select(
        "p_partkey", F.size(arr).cast("long").alias("size_"), F.array_contains(arr, "ECONOMY").alias("contains_"),
        F.array_position(arr, F.col("p_name")).alias("position_"), F.element_at(arr, 2).alias("element_at_"),
        F.array_join(F.slice(arr, 2, 2), "|").alias("slice_"),
        F.size(F.sequence(F.lit(1), F.col("p_size") % 5 + 1)).cast("long").alias("sequence_len"),
        F.array_join(F.array_repeat("p_brand", 2), "|").alias("repeat_"),
        F.arrays_overlap(arr, F.array(F.lit("SMALL"), F.lit("LARGE"))).alias("overlaps_"),
        (F.size(F.filter(arr, lambda x: x == "none")) == 0).alias("is_empty_filter"),
    )


_A = "[p_brand, p_type, split_part(p_name, ' ', 1), p_type]"
_B = "[p_type, 'SMALL', 'MEDIUM', split_part(p_name, ' ', 2)]"


@query(
    "fn_array_set_sort",
    f"""SELECT p_partkey,
               array_to_string(list_sort(list_distinct({_A})), '|') AS distinct_,
               array_to_string(list_sort(list_distinct(list_concat({_A}, {_B}))), '|') AS union_,
               array_to_string(list_sort(list_distinct(list_intersect({_A}, {_B}))), '|') AS intersect_,
               array_to_string(list_sort(list_distinct(list_filter({_A}, lambda x: NOT list_contains({_B}, x)))), '|') AS except_,
               array_to_string(list_filter({_A}, lambda x: x <> 'SMALL'), '|') AS remove_,
               array_to_string(list_sort({_A}), '|') AS sort_, list_min({_A}) AS min_, list_max({_A}) AS max_,
               array_to_string(list_reverse({_A}), '|') AS reverse_, CAST(len(flatten([{_A}, {_B}])) AS BIGINT) AS flatten_len,
               array_to_string(list_transform(range(1, 5), lambda i: concat_ws(':', {_A}[i], {_B}[i])), '|') AS zip_,
               CAST(len({_A}) AS BIGINT) AS shuffle_len
        FROM part""",
)
def fn_array_set_sort(spark, sf):
    p = table(spark, sf, "part")
    first, second = F.split("p_name", " ").getItem(0), F.split("p_name", " ").getItem(1)
    a = F.array("p_brand", "p_type", first, "p_type")
    b = F.array(F.col("p_type"), F.lit("SMALL"), F.lit("MEDIUM"), second)
    j = lambda c: F.array_join(c, "|")
    return p.select(
        "p_partkey", j(F.array_sort(F.array_distinct(a))).alias("distinct_"), j(F.array_sort(F.array_union(a, b))).alias("union_"),
        j(F.array_sort(F.array_intersect(a, b))).alias("intersect_"), j(F.array_sort(F.array_except(a, b))).alias("except_"),
        j(F.array_remove(a, "SMALL")).alias("remove_"), j(F.array_sort(a)).alias("sort_"), F.array_min(a).alias("min_"),
        F.array_max(a).alias("max_"), j(F.reverse(a)).alias("reverse_"),
        F.size(F.flatten(F.array(a, b))).cast("long").alias("flatten_len"),
        j(F.zip_with(a, b, lambda x, y: F.concat_ws(":", x, y))).alias("zip_"), F.size(F.shuffle(a)).cast("long").alias("shuffle_len"),
    )


@query(
    "fn_array_join",
    """SELECT p_partkey, array_to_string(flatten([[p_brand, CAST(p_size AS VARCHAR)], [p_type]]), '_') AS bag_to_string,
              array_to_string([p_name, p_type], ' / ') AS array_join_
       FROM part""",
)
def fn_array_join(spark, sf):
    p = table(spark, sf, "part")
    bag = F.array(F.array("p_brand", F.col("p_size").cast("string")), F.array("p_type"))
    return p.select(
        "p_partkey", F.array_join(F.flatten(bag), "_").alias("bag_to_string"),
        F.array_join(F.array("p_name", "p_type"), " / ").alias("array_join_"),
    )


_NUMS = "[l_quantity, l_extendedprice / 1000, l_discount * 100, l_tax * 100]"


@query(
    "fn_array_higher_order",
    f"""SELECT l_orderkey, l_linenumber, round(list_sum(list_transform({_NUMS}, lambda x: x * 2)), 6) AS transform_sum,
               CAST(len(list_filter({_NUMS}, lambda x: x > 10)) AS BIGINT) AS filter_n,
               list_bool_or(list_transform({_NUMS}, lambda x: x > 50)) AS exists_,
               list_bool_and(list_transform({_NUMS}, lambda x: x >= 0)) AS forall_,
               round(list_reduce({_NUMS}, lambda a, b: a + b), 6) AS aggregate_,
               round(list_sum(list_transform(range(1, 5), lambda i: {_NUMS}[i] * i)), 6) AS zip_with_
        FROM lineitem""",
)
def fn_array_higher_order(spark, sf):
    li = table(spark, sf, "lineitem")
    nums = F.array(F.col("l_quantity"), F.col("l_extendedprice") / 1000, F.col("l_discount") * 100, F.col("l_tax") * 100)
    idx = F.array(*[F.lit(float(i)) for i in (1, 2, 3, 4)])
    summ = lambda arr: F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)
    return li.select(
        "l_orderkey", "l_linenumber", _r(summ(F.transform(nums, lambda x: x * 2))).alias("transform_sum"),
        F.size(F.filter(nums, lambda x: x > 10)).cast("long").alias("filter_n"),
        F.exists(nums, lambda x: x > 50).alias("exists_"), F.forall(nums, lambda x: x >= 0).alias("forall_"),
        _r(summ(nums)).alias("aggregate_"), _r(summ(F.zip_with(nums, idx, lambda x, i: x * i))).alias("zip_with_"),
    )


_MAP_SQL = "MAP {'type': event_type, 'user': 'u' || CAST(user_id AS VARCHAR), 'k': 'k' || json_extract_string(props, '$.k')}"


@query(
    "fn_map",
    f"""SELECT event_id, array_to_string(list_sort(map_keys(m)), ',') AS keyset, array_to_string(list_sort(map_values(m)), ',') AS valuelist,
               array_to_string(list_sort(list_distinct(map_values(m))), ',') AS valueset, m['type'] AS lookup_,
               CAST(len(map_keys(map_concat(m, MAP {{'extra': 'x'}}))) AS BIGINT) AS concat_size,
               array_to_string(list_sort(list_transform(list_filter(map_entries(m), lambda e: starts_with(e.value, 'u')), lambda e: e.key)), ',') AS filtered_keys,
               map(map_values(m), map_keys(m))[event_type] AS inverse_lookup, upper(m['type']) AS transformed_value,
               array_to_string(list_sort(list_transform(map_keys(m), lambda k: upper(k))), ',') AS transformed_keys
        FROM (SELECT event_id, event_type, {_MAP_SQL} AS m FROM events)""",
)
def fn_map(spark, sf):
    e = table(spark, sf, "events")
    m = F.create_map(
        F.lit("type"), F.col("event_type"), F.lit("user"), F.concat(F.lit("u"), F.col("user_id").cast("string")),
        F.lit("k"), F.concat(F.lit("k"), F.get_json_object("props", "$.k")),
    )
    j = lambda c: F.array_join(F.array_sort(c), ",")
    return e.select("event_id", "event_type", m.alias("m")).select(
        "event_id", j(F.map_keys("m")).alias("keyset"), j(F.map_values("m")).alias("valuelist"),
        j(F.array_distinct(F.map_values("m"))).alias("valueset"), F.col("m")["type"].alias("lookup_"),
        F.size(F.map_concat("m", F.create_map(F.lit("extra"), F.lit("x")))).cast("long").alias("concat_size"),
        j(F.map_keys(F.map_filter("m", lambda k, v: v.startswith("u")))).alias("filtered_keys"),
        F.map_from_arrays(F.map_values("m"), F.map_keys("m"))[F.col("event_type")].alias("inverse_lookup"),
        F.transform_values("m", lambda k, v: F.upper(v))["type"].alias("transformed_value"),
        j(F.map_keys(F.transform_keys("m", lambda k, v: F.upper(k)))).alias("transformed_keys"),
    )


@query(
    "fn_struct",
    """SELECT o_orderkey, o_orderstatus AS first_field, o_totalprice AS second_field, 3 AS arity,
              o_orderstatus || ':' || o_orderpriority AS tuple_text
       FROM orders""",
)
def fn_struct(spark, sf):
    o = table(spark, sf, "orders")
    t = o.select("o_orderkey", F.struct("o_orderstatus", "o_totalprice", "o_orderpriority").alias("t"))
    arity = len(t.schema["t"].dataType.fields)
    return t.select(
        "o_orderkey", F.col("t.o_orderstatus").alias("first_field"), F.col("t.o_totalprice").alias("second_field"),
        F.lit(arity).alias("arity"), F.concat_ws(":", "t.o_orderstatus", "t.o_orderpriority").alias("tuple_text"),
    )


_EXPL_BASE = """(SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
                 ELSE list_slice(['a', 'b', 'c'], 1, CAST(json_extract_string(props, '$.k') AS INTEGER) % 4) END AS arr FROM events)"""


@query(
    "fn_explode_family",
    f"""SELECT 'explode' AS fn, event_id, CAST(NULL AS BIGINT) AS pos, unnest(arr) AS val FROM {_EXPL_BASE}
        UNION ALL SELECT 'explode_outer', event_id, NULL, unnest(arr) FROM {_EXPL_BASE}
        UNION ALL SELECT 'explode_outer', event_id, NULL, NULL FROM {_EXPL_BASE} WHERE arr IS NULL OR len(arr) = 0
        UNION ALL SELECT 'posexplode', event_id, unnest(range(len(arr))), unnest(arr) FROM {_EXPL_BASE}
        UNION ALL SELECT 'posexplode_outer', event_id, unnest(range(len(arr))), unnest(arr) FROM {_EXPL_BASE}
        UNION ALL SELECT 'posexplode_outer', event_id, NULL, NULL FROM {_EXPL_BASE} WHERE arr IS NULL OR len(arr) = 0""",
)
def fn_explode_family(spark, sf):
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    arr = F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.slice(F.array(F.lit("a"), F.lit("b"), F.lit("c")), 1, k % 4))
    base = e.select("event_id", arr.alias("arr"))
    ex = base.select(F.lit("explode").alias("fn"), "event_id", F.lit(None).cast("long").alias("pos"), F.explode("arr").alias("val"))
    exo = base.select(F.lit("explode_outer").alias("fn"), "event_id", F.lit(None).cast("long").alias("pos"), F.explode_outer("arr").alias("val"))
    pe = base.select(F.lit("posexplode").alias("fn"), "event_id", F.posexplode("arr").alias("pos", "val"))
    peo = base.select(F.lit("posexplode_outer").alias("fn"), "event_id", F.posexplode_outer("arr").alias("pos", "val"))
    fix = lambda d: d.select("fn", "event_id", F.col("pos").cast("long").alias("pos"), "val")
    return fix(ex).unionByName(fix(exo)).unionByName(fix(pe)).unionByName(fix(peo))


@query(
    "fn_json",
    """SELECT event_id, json_extract_string(props, '$.k') AS get_json, json_extract_string(props, '$.k') AS json_tuple_k,
              CAST(json_extract_string(props, '$.k') AS INTEGER) AS from_json_k,
              to_json({'event_type': event_type, 'user_id': user_id}) AS to_json_, 'STRUCT<k: BIGINT>' AS schema_
       FROM events""",
)
def fn_json(spark, sf):
    e = table(spark, sf, "events")
    return e.select(
        "event_id", F.get_json_object("props", "$.k").alias("get_json"), F.json_tuple("props", "k").alias("json_tuple_k"),
        F.from_json("props", "k INT").getField("k").alias("from_json_k"),
        F.to_json(F.struct("event_type", "user_id")).alias("to_json_"),
        F.schema_of_json(F.lit('{"k": 87}')).alias("schema_"),
    )


@query(
    "fn_csv",
    """SELECT event_id, event_type || ',' || CAST(user_id AS VARCHAR) || ',' || CAST(value AS VARCHAR) AS to_csv_,
              event_type AS a, user_id::INTEGER AS b, value AS c, 'STRUCT<_c0: STRING, _c1: INT, _c2: DOUBLE>' AS schema_
       FROM events""",
)
def fn_csv(spark, sf):
    e = table(spark, sf, "events")
    line = F.to_csv(F.struct("event_type", "user_id", "value"))
    return e.select("event_id", line.alias("to_csv_")).select(
        "event_id", "to_csv_", F.from_csv("to_csv_", "a STRING, b INT, c DOUBLE").alias("p"),
        F.schema_of_csv(F.lit("view,8,6.55")).alias("schema_"),
    ).select("event_id", "to_csv_", "p.a", "p.b", "p.c", "schema_")


@query(
    "fn_xpath_extract",
    """SELECT o_orderkey, o_orderstatus AS status, o_orderpriority || '|' || CAST(o_custkey AS VARCHAR) AS all_p,
              CAST(o_custkey AS DOUBLE) AS cust_num
       FROM orders""",
)
def fn_xpath_extract(spark, sf):
    """XPath first / all / number over XML text built from each order."""
    o = table(spark, sf, "orders")
    xml = F.concat(
        F.lit("<o><id>"), F.col("o_orderkey").cast("string"), F.lit("</id><st>"), F.col("o_orderstatus"),
        F.lit("</st><p>"), F.col("o_orderpriority"), F.lit("</p><p>"), F.col("o_custkey").cast("string"), F.lit("</p></o>"),
    )
    return o.select("o_orderkey", xml.alias("xml")).select(
        "o_orderkey", F.xpath_string("xml", F.lit("/o/st")).alias("status"),
        F.array_join(F.xpath("xml", F.lit("/o/p/text()")), "|").alias("all_p"),
        F.xpath_number("xml", F.lit("/o/p[2]")).alias("cust_num"),
    )


@query(
    "fn_log_fields",
    """SELECT page_id, regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1) AS host,
              url_decode(regexp_extract(url, '[?&]ref=([^&#]*)', 1)) AS ref_term,
              CASE WHEN url LIKE '%?%' THEN regexp_extract(url, '[?&]page=([^&#]*)', 1) END AS page_param,
              regexp_extract(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1), '([^.]+\\.[^.]+)$', 1) AS domain,
              CASE regexp_extract(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1), '([^.]+\\.[^.]+)$', 1)
                   WHEN 'google.com' THEN 'Google' WHEN 'bing.com' THEN 'Bing' WHEN 'ask.com' THEN 'Ask dot com' END AS engine
       FROM pages""",
)
def fn_log_fields(spark, sf, hosts=None):
    """Host, query term, domain and search engine of a URL; the engine comes from
    the host table in file ``hosts`` (the reference's if none is named), joined on
    the whole host and its suffixes."""
    p = table(spark, sf, "pages").select("page_id", "url")
    host = F.regexp_extract("url", r"^[a-zA-Z]+://([^/:?#]+)", 1)
    out = p.select(
        "page_id", host.alias("host"),
        F.url_decode(F.regexp_extract("url", r"[?&]ref=([^&#]*)", 1)).alias("ref_term"),
        F.when(F.col("url").contains("?"), F.regexp_extract("url", r"[?&]page=([^&#]*)", 1)).alias("page_param"),
        F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"),
    )
    return W.search_host(out, "host", W.host_table(spark, hosts)).select("page_id", "host", "ref_term", "page_param", "domain", "engine")


@query(
    "fn_rare_builtins",
    with_ctes(
        CUSTOMER_NULLS_SQL,
        body="""SELECT c_custkey, CASE WHEN nation % 5 = 0 THEN 0.0 ELSE bal END AS bal_or_zero, 'k' || CAST(c_custkey % 3 AS VARCHAR) AS first_key,
                       c_custkey % 3 + 10 AS zipped, CAST(c_custkey % 3 + 2 * (c_custkey % 4) AS BIGINT) AS summed,
                       (c_custkey % 30) AS months, true AS from_file, NULL::VARCHAR AS checked,
                       row_number() OVER (PARTITION BY nation ORDER BY bal DESC NULLS FIRST, c_custkey) AS place
                FROM customer_nulls""",
    ),
)
def fn_rare_builtins(spark, sf):
    """nanvl, map_from_entries, arrays_zip, map_zip_with, months_between, input_file_name, raise_error, desc_nulls_first."""
    from pyspark.sql import Window

    c = customer_nulls(spark, sf)
    k3, k4 = F.col("c_custkey") % 3, F.col("c_custkey") % 4
    key = F.concat(F.lit("k"), k3.cast("string"))
    entries = F.map_from_entries(F.array(F.struct(key, k3), F.struct(F.lit("z"), k4)))
    zipped = F.arrays_zip(F.array(k3, k4).alias("a"), F.array(k3 + 10, k4 + 10).alias("b"))
    both = F.map_zip_with(F.create_map(F.lit("x"), k3), F.create_map(F.lit("x"), 2 * k4), lambda k, a, b: a + b)
    start = F.lit("2000-01-01").cast("date")
    files = table(spark, sf, "customer").select(F.col("c_custkey").alias("fk"), F.input_file_name().contains("customer").alias("from_file"))
    place = Window.partitionBy("nation").orderBy(F.desc_nulls_first("bal"), "c_custkey")
    return c.withColumn("place", F.row_number().over(place)).join(files, F.col("c_custkey") == F.col("fk")).select(
        "c_custkey", F.nanvl(F.when(F.col("nation") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("bal")), F.lit(0.0)).alias("bal_or_zero"),
        F.map_keys(entries)[0].alias("first_key"), zipped[0]["b"].alias("zipped"), F.element_at(both, "x").cast("long").alias("summed"),
        F.months_between(F.add_months(start, (F.col("c_custkey") % 30).cast("int")), start).cast("long").alias("months"),
        "from_file", F.when(F.col("c_custkey") < 0, F.raise_error(F.lit("negative key"))).cast("string").alias("checked"), "place")
