from pyspark.sql import types as T

from cdclake.operators import entities as ent

TXN = T.StructType([
    T.StructField("card1", T.LongType()), T.StructField("card4", T.StringType()), T.StructField("card6", T.StringType()),
    T.StructField("addr1", T.DoubleType()), T.StructField("addr2", T.DoubleType()),
    T.StructField("P_emaildomain", T.StringType()), T.StructField("card2", T.DoubleType()), T.StructField("card3", T.DoubleType()),
])


def test_accounts_keep_three_digit_sequence(spark):
    rows = [(c, "visa", "credit", 315.0, 87.0, "gmail.com", 1.0, 2.0) for c in range(1, 106)]
    txn = spark.createDataFrame(rows, TXN)
    users = ent.resolve_users(txn)
    assert [r.client_no for r in users.collect()] == ["00000001"]
    acc = {r.linked_raw_card_bin: r for r in ent.assign_accounts(txn, ent.number_clients(txn)).collect()}
    assert acc[1].account_number == "1900000000101" and acc[1].is_primary
    assert acc[100].account_number == "19000000001100"  # '100', not '10'
    assert acc[100].account_name == "ACCT Credit 100"
    assert sum(r.is_primary for r in acc.values()) == 1


def test_accounts_defaults_and_unknown_client(spark):
    rows = [(1, "visa", "", 10.0, None, "a.com", None, None), (2, "visa", None, 10.0, None, "", None, None)]
    txn = spark.createDataFrame(rows, TXN)
    users = ent.resolve_users(txn)
    assert sorted(r.raw_email_domain for r in users.collect()) == ["a.com", "unknown.com"]
    acc = ent.assign_accounts(txn, ent.number_clients(txn)).collect()
    # empty e-mail domain: profile stored as 'unknown.com', so the account lookup finds no client
    assert [(r.linked_raw_card_bin, r.linked_card_type) for r in acc] == [(1, "debit")]


def test_derived_dimensions(spark):
    rows = [(1, "visa", "credit", 1.0, None, "a.com", 2.6, 3.5), (1, "visa", "debit", None, 5.0, "a.com", 2.4, 3.5),
            (2, None, "credit", None, None, "a.com", None, None)]
    txn = spark.createDataFrame(rows, TXN)
    loc = [(r.LocationID, r.addr1, r.addr2) for r in ent.derive_location(txn).orderBy("LocationID").collect()]
    assert loc == [(1, None, 5.0), (2, 1.0, None)]
    nets = [(r.Card_Network_ID, r.Network_Name, r.Card_Type) for r in ent.derive_networks(txn).orderBy("Card_Network_ID").collect()]
    assert nets == [(1, "visa", "credit"), (2, "visa", "debit")]
    banks = {r.Bank_ID: (r.Bank_Country_Code, r.Bank_Sub_Branch) for r in ent.derive_banks(txn).collect()}
    assert banks == {1: (4, 2), 2: (None, None)}  # one row per card; half-even rounding of 3.5 -> 4


def test_long_domains_keep_their_own_clients(spark):
    long = "x" * 150
    rows = [(c, "visa", "credit", 1.0, None, f"{long}{d}.com", None, None) for c, d in ((1, "a"), (2, "b"))]
    txn = spark.createDataFrame(rows, TXN)
    clients = ent.number_clients(txn)
    acc = {r.linked_raw_card_bin: r.client_no for r in ent.assign_accounts(txn, clients).collect()}
    assert acc == {1: "00000001", 2: "00000002"}
    assert {len(r.raw_email_domain) for r in ent.user_profiles(clients).collect()} == {100}


def test_last_client_is_the_largest_number(spark):
    clients = spark.createDataFrame([(1.2, "a.com", "99999999"), (1.7, "a.com", "100000000")], "addr1 double, P_emaildomain string, client_no string")
    assert ent.client_lookup(clients).first().client_no == "100000000"


def test_numbers_stay_when_a_pair_is_added(spark):
    def txn(pairs):
        return spark.createDataFrame([(1, "visa", "credit", a, None, m, None, None) for a, m in pairs], TXN)

    first = ent.number_clients(txn([(5.0, "m.com"), (7.0, "k.com")]))
    again = ent.number_clients(txn([(5.0, "m.com"), (1.0, "a.com"), (7.0, "k.com")]), first)
    assert {(r.addr1, r.P_emaildomain): r.client_no for r in again.collect()} == {
        (5.0, "m.com"): "00000001", (7.0, "k.com"): "00000002", (1.0, "a.com"): "00000003",
    }
    places = ent.derive_location(txn([(5.0, "x")]))
    more = ent.derive_location(txn([(1.0, "x"), (5.0, "x")]), places)
    assert {r.addr1: r.LocationID for r in more.collect()} == {5.0: 1, 1.0: 2}
