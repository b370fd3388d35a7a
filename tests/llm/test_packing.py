"""Token ids are those of the library, and the binary files hold what the table holds."""

import pathlib
import random

import numpy as np
import pytest

from textgrove.llm import packing


@pytest.mark.parametrize("end", ["", "x", "\n", "  y"])
def test_spaces_beside_other_white_space(end):
    encode, plain = packing.tokenizer(), library()
    rng = random.Random(5)
    texts = ["    ", "a \nb", "a  b", " a ", "\t \t"]
    texts += ["".join(rng.choice("ab   \n\t　\x1c'") for _ in range(rng.randint(1, 9))) for _ in range(20000)]
    assert [t for t in texts if encode(t + end).tolist() != plain(t + end)] == []


def library():
    import base64

    import tiktoken

    with open(packing.VOCABULARY, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("file", pat_str=packing.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@pytest.mark.parametrize("pool", [1 << 22, 5000])
def test_binary_round_trip(spark, docs, odd, tmp_path, pool):
    """Files give back the rows of ``pack`` of the same partitions, whatever the scheme of the folder."""
    for k, table in enumerate((docs.repartition(3, "doc_id"), odd.repartition(2, "doc_id"))):
        folder = f"{tmp_path}/{k}" if k else f"file://{tmp_path}/{k}"
        manifest = packing.write_binary(table, folder, length=128, pool=pool)
        packed = packing.pack(table, length=128, pool=pool).collect()
        read = packing.read_binary(spark, folder).collect()
        fields = ("input_ids", "cu_seqlens", "position_ids")
        wanted = sorted(((r["pack_id"] >> 33, r["pack_id"] & (1 << 33) - 1, *[tuple(r[f]) for f in fields]) for r in packed))
        assert sorted((r["part"], r["row"], *[tuple(r[f]) for f in fields]) for r in read) == wanted
        total = manifest.groupBy().sum("rows", "segments", "tokens").first()
        assert tuple(total) == (len(packed), sum(len(r["starts"]) for r in packed), sum(r["cu_seqlens"][-1] for r in packed))


def test_binary_files_are_flat_and_guarded(spark, docs, empty, tmp_path):
    one = packing.write_binary(docs.coalesce(1), f"{tmp_path}/flat", length=64).first()
    at = lambda kind: pathlib.Path(f"{tmp_path}/flat/data/{one['file']}.{kind}")
    ids, positions = (np.fromfile(at(k), "<i4").reshape(one["rows"], 64) for k in ("ids", "positions"))
    bounds, offsets = np.fromfile(at("bounds"), "<i4"), np.fromfile(at("offsets"), "<i8")
    assert offsets[-1] == len(bounds) and len(offsets) == one["rows"] + 1
    for r in (0, one["rows"] // 2, one["rows"] - 1):
        ends = bounds[offsets[r] : offsets[r + 1]]
        assert ends[0] == 0 and set(np.flatnonzero(positions[r][: ends[-1]] == 0)) == set(ends[:-1])
        assert (ids[r, ends[-1] :] == packing.END).all()
    # files of a lost attempt count for nothing; a changed file is an error
    at("ids").with_name("part-000000-99.ids").write_bytes(b"lost")
    assert packing.read_binary(spark, f"{tmp_path}/flat").count() == one["rows"]
    at("ids").write_bytes(at("ids").read_bytes()[:-4] + b"\0\0\0\0")
    with pytest.raises(Exception, match="manifest"):
        packing.read_binary(spark, f"{tmp_path}/flat").collect()
    assert packing.write_binary(empty, f"{tmp_path}/none").count() == 0
    assert packing.read_binary(spark, f"{tmp_path}/none").count() == 0
