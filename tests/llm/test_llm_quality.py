import brute

from riskframe.llm import quality_lines as Q

SF = "/root/testdata/sf0.001"
COLUMNS = ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_words"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, source string, text string, key int")


def test_matches_brute_force_with_edge_cases(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text").collect()]
    rows += [(-1, None, None), (-2, "a", ""), (-3, "a", "a b\n\na  b\nA b\na b\n x"), (None, "src0", "ab cd ef gh ij " * 9), rows[2], rows[2],
             (-4, "b", "é ü #|<>&   x " * 400), (-5, "b", "w " * 30000)]
    for i in range(30):
        words = " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}w{chr(97 + j)}" for j in range(3 if i % 2 else 30))
        rows.append((1000 + i, "h", f"Share this  page now 12\n{words}\nshare THIS page now 34"))
    got = brute.order(tuple(r) for r in Q.quality_figures(frame(spark, rows)).select(*COLUMNS).collect())
    want = brute.quality(rows)
    assert got == want
    assert any(r[8] and not r[7] and not r[6] for r in want) and any(r[8] and r[7] for r in want)


def test_exact_copies_count_as_one_document(spark):
    rows = [(i, "h", "\n".join(" ".join(f"{j}{k}" for k in range(9)) for j in "abc")) for i in range(40)]
    assert all(r["kept"] for r in Q.quality_figures(frame(spark, rows)).collect())


def test_empty_table_and_stage_columns(spark):
    assert Q.quality_figures(frame(spark, [])).collect() == []
    rows = [(1, "a", " ".join(f"w{i}" for i in range(12))), (2, "a", "short"), (None, None, None), (1, "a", " ".join(f"w{i}" for i in range(12)))]
    df = frame(spark, rows)
    got = Q.stage_quality(spark, df, SF)
    assert got.columns == df.columns and [r["doc_id"] for r in got.collect()] == [1, 1]


def test_stage_takes_boilerplate_lines_out_of_the_text(spark):
    own = [[" ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}{p}{chr(97 + j)}" for j in range(9)) for p in "abc"] for i in range(30)]
    rows = [(i, "h", f"{a}\n\nShare this  page now {i}\n{b} é\nshare THIS page now 7\n{c}" + ("\nSHARE this page now 0" if i % 2 else "\n"))
            for i, (a, b, c) in enumerate(own)]
    rows += [(100, "other", rows[0][2]), (None, "h", rows[3][2]), (200, "h", "Share this page now 1\n" * 3 + "a few more words than ten are here now it is"), rows[5]]
    got = {}
    for r in Q.stage_quality(spark, frame(spark, rows), SF).collect():
        got.setdefault(r["doc_id"], []).append(r["text"])
    want = [f"{a}\n\n{b} é\n{c}" + ("" if i % 2 else "\n") for i, (a, b, c) in enumerate(own)]
    assert all(got[i] == [want[i]] * (1 + (i == 5)) for i in range(30))
    assert got[100] == [rows[0][2]] and got[None] == [want[3]]


def hosts_of(n):
    """n pages: a line of five words on one in 12, a passage of over fifty words
    on one in 30, a line of two words on one in 30."""
    passage = " ".join(f"passage{j}" for j in "abcdefghijklmnopqrstuvwxyz" for _ in range(2)) + " and some words to more than fifty"
    rows = []
    for i in range(n):
        text = "\n".join(" ".join(f"u{chr(97 + i % 26)}{chr(97 + i // 26)}{p}w{chr(97 + j)}" for j in range(26)) + f" {p}" for p in "abcd")
        rows.append((i, "hot", text + ("\nOne line of fifty pages" if i % 12 == 0 else "") + (f"\n{passage}" if i % 30 == 1 else "")
                     + ("\nRead on" if i % 30 == 2 else "")))
    return rows, len(passage.split())


def test_limit_by_host_size_and_line_length(spark):
    rows, words = hosts_of(600)                            # 50, 20 and 20 of 600; limits 33.8, 10 and 53.4
    got = {r["id"]: r["lost_words"] for r in Q.quality_figures(frame(spark, rows)).collect()}
    assert all(got[i] == 5 * (i % 12 == 0) + words * (i % 30 == 1) for i in range(600))
    for broadcast in (Q.BROADCAST_LINES, 0):
        texts = [r["text"] for r in Q.clean(frame(spark, rows), broadcast_lines=broadcast).collect()]
        assert len(texts) == 600 and sum("Read on" in t for t in texts) == 20
        assert not any("One line" in t or "passage" in t for t in texts)


def test_both_ways_of_cleaning_agree(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source", "text").collect()]
    rows += [(None, None, None), (-1, "src0", ""), rows[4], rows[4], (-2, None, "a line\n" * 12)]
    one, other = (brute.order(tuple(r) for r in Q.clean(frame(spark, rows), broadcast_lines=n).collect()) for n in (Q.BROADCAST_LINES, 0))
    assert one == other and 0 < len(one) < len(rows)


def test_share_of_marked_documents_is_alike_at_both_sizes(spark):
    for sf in ("sf0.01", "sf0.1"):
        marked = Q.quality_figures(spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")).agg(
            {"lost_words": "count"}).first()[0], Q.quality_figures(spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")).filter("lost_words > 0").count()
        assert 0.05 <= marked[1] / marked[0] <= 0.15, (sf, marked)
