"""Readers: sample folders, imzML and its binary arrays, lipid lists, GeoJSON, configuration."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folder names that hold results, not samples.
RESERVED = frozenset({"merged", "aligned", "registered", "multimodal", "logs", "cache", "annotated"})
#: Image suffixes, best first.
IMAGE_SUFFIXES = (".ome.tiff", ".ome.tif", ".qptiff", ".tiff", ".tif", ".czi")


def sample_ids(path: str, ignore: set[str] = frozenset()) -> list[str]:
    """Sorted sub-folders that aren't reserved, hidden or ignored."""
    return sorted(e.name for e in os.scandir(path) if e.is_dir() and not e.name.startswith(".") and e.name not in RESERVED | set(ignore))


def imzml_pair(folder: str) -> tuple[str, str] | None:
    """The first .imzML by name and the .ibd of the same stem; None without either kind, an error for half a pair."""
    names = sorted(os.listdir(folder))
    xml, ibd = ([n for n in names if n.lower().endswith(s)] for s in (".imzml", ".ibd"))
    if not xml and not ibd:
        return None
    if xml and (mate := next((n for n in ibd if os.path.splitext(n)[0] == os.path.splitext(xml[0])[0]), None)):
        return os.path.join(folder, xml[0]), os.path.join(folder, mate)
    raise FileNotFoundError(f"incomplete imzML pair in {folder}")


def image_file(folder: str) -> str | None:
    """The file of the best image suffix, the first by name among equals."""
    rank = lambda n: next((i for i, s in enumerate(IMAGE_SUFFIXES) if n.lower().endswith(s)), None)
    found = sorted((rank(n), n) for n in os.listdir(folder) if rank(n) is not None)
    return os.path.join(folder, found[0][1]) if found else None


ION_MODES = ("pos", "neg")


def ion_modes(folder: str) -> list[str]:
    """Modes whose folder holds a complete pair; an error where none does or a pair is incomplete."""
    found = [m for m in ION_MODES if os.path.isdir(os.path.join(folder, m)) and imzml_pair(os.path.join(folder, m))]
    if not found:
        raise FileNotFoundError(f"no imzML pair for any ion mode in {folder}")
    return found


def imzml_header(spark: SparkSession, path: str) -> dict:
    """``mz_type`` and ``intensity_type`` (numpy names; an error where the file says neither 32 nor 64 bit), ``raster_x`` and ``raster_y`` (1, 1 where either pixel size is absent or zero)."""
    param = "array<struct<_name:string,_value:string>>"
    groups = spark.read.format("xml").option("rowTag", "referenceableParamGroup").schema(f"_id string, cvParam {param}").load(path)
    bits = {"32-bit float": "<f4", "64-bit float": "<f8"}
    types = {}
    for r in groups.collect():  # a handful a file
        for p in r["cvParam"] or []:
            name = p["_name"] or ""
            if r["_id"] == "mzArray" and name in bits:
                types["mz_type"] = bits[name]
            if r["_id"] in ("intensities", "intensityArray") and name in bits:
                types["intensity_type"] = bits[name]
    if len(types) < 2:
        raise KeyError(f"{path} doesn't name the float types of its arrays")
    settings = spark.read.format("xml").option("rowTag", "scanSettings").schema(f"cvParam {param}").load(path)
    size = {p["_name"]: int(float(p["_value"])) for r in settings.collect() for p in r["cvParam"] or [] if (p["_name"] or "").startswith("pixel size ")}
    x, y = size.get("pixel size x", 0), size.get("pixel size y", 0)
    return {**types, "raster_x": x if x and y else 1, "raster_y": y if x and y else 1}


def read_imzml(spark: SparkSession, path: str, raster_x: float = 1, raster_y: float = 1) -> DataFrame:
    """One row a spectrum: pixel and physical position, and where its arrays lie (n, bytes, offset).

    A spectrum that lacks either physical coordinate is placed by its pixel times the raster on both axes.
    """
    schema = "cvParam array<struct<_name:string,_value:string>>"
    raw = spark.read.format("xml").option("rowTag", "spectrum").schema(
        "_index bigint, scanList struct<scan:struct<" + schema.replace(" ", ":", 1) + "," + schema.replace(" ", ":", 1).replace("cvParam", "userParam") + ">>, binaryDataArrayList struct<binaryDataArray:array<struct<cvParam:array<struct<_name:string,_value:string>>,referenceableParamGroupRef:struct<_ref:string>>>>"
    ).load(path)
    scan = "scanList.scan.cvParam"
    own = "concat(coalesce(scanList.scan.userParam, array()), coalesce(scanList.scan.cvParam, array()))"  # the format has physical positions among the user's parameters
    value = lambda arr, name: f"try_element_at(filter({arr}, p -> p._name = '{name}'), 1)._value"
    out = raw.selectExpr(
        "_index as spot_id",
        f"try_cast({value(scan, 'position x')} as int) px",
        f"try_cast({value(scan, 'position y')} as int) py",
        f"try_cast({value(own, '3DPositionX')} as double) x3",
        f"try_cast({value(own, '3DPositionY')} as double) y3",
        "binaryDataArrayList.binaryDataArray as arrays",
    )
    mine = lambda names, k: f"coalesce(try_element_at(filter(arrays, a -> a.referenceableParamGroupRef._ref in ({names})), 1), try_element_at(arrays, {k}))"
    part = lambda of, name, kind: f"cast({value(of + '.cvParam', name)} as {kind})"
    locator = lambda of: f"struct({part(of, 'external array length', 'bigint')} as n, {part(of, 'external encoded length', 'bigint')} as n_bytes, {part(of, 'external offset', 'bigint')} as offset)"
    out = out.withColumns({"mz_a": F.expr(mine("'mzArray'", 1)), "in_a": F.expr(mine("'intensities', 'intensityArray'", 2))})
    both = "x3 is not null and y3 is not null"
    return out.selectExpr("spot_id", "px", "py", f"if({both}, x3, px * {float(raster_x)}D) x", f"if({both}, y3, py * {float(raster_y)}D) y", f"{locator('mz_a')} mz_at", f"{locator('in_a')} intensity_at")


def read_arrays(spectra: DataFrame, ibd: str, mz_type: str = "<f8", intensity_type: str = "<f4") -> DataFrame:
    """Read the arrays of located spectra from the binary file, which every executor must reach under ``ibd``; a short read is an error.

    Types come from ``imzml_header``.  Spectra are dealt by ranges of the offset and read in its order,
    so a task reads one stretch of the file.
    """

    def run(batches):
        import pyarrow as pa

        with open(ibd, "rb") as f:

            def read(at, kind):
                f.seek(at["offset"])
                size = at["n"] * np.dtype(kind).itemsize
                data = f.read(size)
                if len(data) != size:
                    raise EOFError(f"{ibd} ends before offset {at['offset'] + size}")
                return np.frombuffer(data, dtype=kind).astype(np.float64)

            def lists(places, kind):
                found = [read(a, kind) for a in places]
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found) if found else np.zeros(0)))

            for batch in batches:
                for k in range(0, batch.num_rows, 256):
                    part = batch.slice(k, 256)
                    arrays = [lists(part.column(c).to_pylist(), t) for c, t in (("mz_at", mz_type), ("intensity_at", intensity_type))]
                    head = ["spot_id", "px", "py", "x", "y"]
                    yield pa.RecordBatch.from_arrays([*[part.column(c) for c in head], *arrays], names=[*head, "mz", "intensity"])

    size = spectra.agg(F.sum(F.col("mz_at.n") * np.dtype(mz_type).itemsize + F.col("intensity_at.n") * np.dtype(intensity_type).itemsize)).first()[0] or 0
    dealt = spectra.repartitionByRange(max(1, size // 64_000_000), F.col("mz_at.offset")).sortWithinPartitions("mz_at.offset")
    return dealt.mapInArrow(run, "spot_id bigint, px int, py int, x double, y double, mz array<double>, intensity array<double>")


def image_size(shape: tuple[int, ...], axes: str | None) -> tuple[int, int]:
    """(height, width) by the axes' letters; the last two dimensions where these don't name Y and X."""
    at = (axes or "").upper()
    known = len(at) == len(shape) and "Y" in at and "X" in at
    return (shape[at.index("Y")], shape[at.index("X")]) if known else (shape[-2], shape[-1])


#: Micrometres in a unit of length.
MICROMETRES = {"m": 1e6, "um": 1.0}


def read_scans(path: str) -> list[dict]:
    """Scan parameters of a tiled spectral image from its XML description, in file order.

    Per image: name, index, height, width, pixel sizes in micrometres, wavelength steps, first and last
    wavelength, pump wavelength and laser, number of tiles and their positions; None where the file
    says nothing.  A unit of length other than m or um is an error, as is a file without images.
    """
    from xml.etree import ElementTree

    root = ElementTree.parse(path).getroot()
    images = [e for e in root.iter("Element") if e.find("Data/Image") is not None]
    if not images:
        raise ValueError(f"no image in {path}")
    out = []
    for k, e in enumerate(images):
        scan = dict.fromkeys(("height", "width", "pixel_y", "pixel_x", "steps", "first_nm", "last_nm", "laser", "pump_nm", "tiles"))
        scan |= {"name": e.get("Name", f"image {k + 1}"), "index": k}
        for d in e.iterfind("Data/Image/ImageDescription/Dimensions/DimensionDescription"):
            which, n = int(d.get("DimID")), int(d.get("NumberOfElements"))
            if which in (1, 2):
                if d.get("Unit") not in MICROMETRES:
                    raise ValueError(f"unit {d.get('Unit')!r} in {scan['name']}")
                size, pixel = ("height", "pixel_y") if which == 1 else ("width", "pixel_x")
                scan |= {size: n, pixel: float(d.get("Length")) * MICROMETRES[d.get("Unit")] / n}
            elif which in (9, 10):
                scan["steps" if which == 9 else "tiles"] = n
        for setting in e.iterfind("Data/Image/Attachment[@Name='HardwareSetting']//ATLConfocalSettingDefinition"):
            light = setting.find("LambdaDefinition/LambdaExcitation")
            if light is not None and scan["first_nm"] is None:
                either = lambda end, light=light: light.get(f"LambdaExcitation{end}Double", light.get(f"LambdaExcitation{end}"))
                scan |= {"first_nm": float(either("Begin")), "last_nm": float(either("End"))}
            laser = next((x for x in setting.iterfind("LaserArray/Laser") if x.get("PumpWavelength")), None)
            if laser is not None and scan["pump_nm"] is None:
                scan |= {"pump_nm": float(laser.get("PumpWavelength")), "laser": laser.get("LaserName", "")}
        scan["positions"] = [(float(t.get("PosX")), float(t.get("PosY"))) for t in e.iterfind("Data/Image/Attachment[@Name='TileScanInfo']/Tile")]
        out.append(scan)
    return out


def scan_axis(spark: SparkSession, scans: list[dict]) -> DataFrame:
    """Wavenumbers of all scans' channels, one axis after the other: (scan, idx, wavenumber)."""
    from lattica.functions.expressions import wavenumber

    rows = [(s["index"], s["steps"], s["first_nm"], s["last_nm"], s["pump_nm"]) for s in scans]
    d = spark.createDataFrame(rows, "scan int, steps int, first double, last double, pump double").withColumn("k", F.explode(F.sequence(F.lit(0), F.col("steps") - 1)))
    nm = F.col("first") + F.col("k") * (F.col("last") - F.col("first")) / F.greatest(F.lit(1), F.col("steps") - 1)
    before = {s["index"]: sum(t["steps"] for t in scans[:i]) for i, s in enumerate(scans)}
    start = F.create_map(*[F.lit(x) for kv in before.items() for x in kv])
    return d.select("scan", (start[F.col("scan")] + F.col("k")).cast("long").alias("idx"), wavenumber(nm, F.col("pump")).alias("wavenumber"))


def read_lipids(spark: SparkSession, path: str) -> DataFrame:
    """A .csv or .json mass list with db_name, ionized_mass and ion_mode, in file order (``ord``)."""
    if path.endswith(".csv"):
        df = spark.read.csv(path, header=True)
    elif path.endswith(".json"):
        df = spark.read.json(path, multiLine=True)
    else:
        raise ValueError(f"neither .csv nor .json: {path}")
    if missing := {"db_name", "ionized_mass", "ion_mode"} - set(df.columns):
        raise ValueError(f"missing columns: {sorted(missing)}")
    return df.select(F.monotonically_increasing_id().alias("ord"), "db_name", F.col("ionized_mass").cast("double").alias("ionized_mass"), "ion_mode")


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Polygons and multi-polygons as (region_id, label, rings), exterior rings only; label: classification, name, id or 'unknown'."""
    kind = "features array<struct<id:string,geometry:struct<type:string,coordinates:string>,properties:struct<name:string,classification:struct<name:string>>>>"
    f = spark.read.schema(kind).json(path, multiLine=True).select(F.posexplode("features").alias("k", "f"))
    f = f.filter(F.col("f.geometry.type").isin("Polygon", "MultiPolygon"))
    poly = F.from_json("f.geometry.coordinates", "array<array<array<double>>>")
    multi = F.from_json("f.geometry.coordinates", "array<array<array<array<double>>>>")
    outer = F.when(F.col("f.geometry.type") == "Polygon", F.slice(poly, 1, 1)).otherwise(F.transform(multi, lambda p: p[0]))
    rings = F.transform(outer, lambda r: F.transform(r, lambda q: F.struct(q[0].alias("x"), q[1].alias("y"))))
    name = lambda c: F.nullif(F.col(c), F.lit(""))
    return f.select(F.col("k").cast("long").alias("region_id"), F.coalesce(name("f.properties.classification.name"), name("f.properties.name"), name("f.id"), F.lit("unknown")).alias("label"), rings.alias("rings"))


@dataclass
class Modality:
    name: str
    type: str
    settings: dict = field(default_factory=dict)
    registration: str = "none"
    alignment: str = "manual"


@dataclass
class Config:
    """A validated run configuration."""

    dataset_path: str
    modalities: list[Modality]
    reference: str
    align: bool = False
    register: bool = False
    ignore_samples: list[str] = field(default_factory=list)
    annotations: dict | None = None


#: Registrations that each modality type may use.
REGISTRATIONS = {"msi": {"spot_interpolation", "spot_aggregation"}, "st": {"spot_interpolation", "spot_aggregation"}, "raman": {"raman_pixel"}, "microscopy_image": {"feature_extraction"}}
STRATEGIES = ("manual", "pre_aligned")
SPOT_TYPES = frozenset({"msi", "st"})
#: Parameters of each modality type: kind, default, and the values of a choice.
PARAMETERS = {
    "microscopy_image": {"color_enhancement": ("bool", True), "remove_background": ("bool", True), "crop_to_tissue": ("bool", True), "background_color": ("choice", "white", ("white", "black")), "min_object_coverage": ("float", 0.01), "clip_percentile": ("int", 99), "crop_margin": ("int", 250), "gamma": ("float", 0.45), "contrast_saturation": ("float", 0.35)},
    "msi": {"lipid_annotation_db": ("path", None), "mass_tolerance": ("float", 10), "frequency_threshold": ("float", 0.01), "sample_type": ("choice", "tissue", ("tissue", "microgrid"))},
    "st": {"min_counts": ("int", None), "max_counts": ("int", None), "min_genes": ("int", None), "max_genes": ("int", None)},
    "raman": {"workers": ("int", 8)},
}


def settings_of(kind: str, given: dict) -> tuple[dict, list[str]]:
    """A modality type's parameters with defaults, and what is wrong with the given ones (unknown names are passed on)."""
    accepts = {"bool": bool, "int": int, "float": (int, float), "path": str, "choice": str}
    out, wrong = {k: v[1] for k, v in PARAMETERS.get(kind, {}).items()} | given, []
    for k, v in given.items():
        rule = PARAMETERS.get(kind, {}).get(k)
        if rule is None or v is None:
            continue
        if not isinstance(v, accepts[rule[0]]) or (isinstance(v, bool) and rule[0] != "bool"):
            wrong.append(f"{k} must be {rule[0]}")
        elif rule[0] == "choice" and v not in rule[2]:
            wrong.append(f"{k} must be one of {', '.join(rule[2])}")
    return out, wrong


def read_config(path: str, inputs: bool = False) -> Config:
    """Parse and check a JSON configuration; every violation is named in one error.

    With ``inputs`` the folders are looked at too: samples exist, each has each modality's folder, mass
    spectra have a complete pair of files, lists and annotations that are named exist (one GeoJSON a sample).
    """
    with open(path) as f:
        raw = json.load(f)
    if not isinstance(raw, dict):
        raise ValueError("the configuration isn't an object")
    wrong = [f"missing {k}" for k in ("dataset_path", "modalities", "reference_modality") if k not in raw]
    kinds = {"dataset_path": str, "modalities": list, "reference_modality": str, "perform_alignment": bool, "perform_registration": bool, "ignore_samples": list, "samples": list}
    wrong += [f"{k} must be {t.__name__}" for k, t in kinds.items() if raw.get(k) is not None and not isinstance(raw[k], t)]
    wrong += [f"{k} must hold names" for k in ("ignore_samples", "samples") if isinstance(raw.get(k), list) and not all(isinstance(v, str) for v in raw[k])]
    listed = [m for m in raw.get("modalities") or [] if isinstance(m, dict)] if isinstance(raw.get("modalities"), list) else []
    wrong += ["no modalities"] if raw.get("modalities") == [] else []
    wrong += ["a modality isn't an object"] if isinstance(raw.get("modalities"), list) and len(listed) < len(raw["modalities"]) else []
    mods = []
    for m in listed:
        settings, bad = settings_of(m.get("type", ""), m.get("processing_settings") or {})
        wrong += [f"{m.get('name')}: {b}" for b in bad]
        mods.append(Modality(m.get("name", ""), m.get("type", ""), settings, m.get("registration_type") or "none", m.get("alignment_strategy") or "manual"))
    names, by = [m.name for m in mods], {m.name: m for m in mods}
    wrong += [f"modality without a name or with an unknown type: {m.name} {m.type}" for m in mods if not m.name or m.type not in REGISTRATIONS]
    wrong += ["modality names must differ"] if len(set(names)) < len(names) else []
    reference = raw.get("reference_modality")
    wrong += [f"unknown reference {reference!r}"] if reference is not None and reference not in names else []
    wrong += [f"{m.registration} doesn't fit {m.type}" for m in mods if m.registration != "none" and m.registration not in REGISTRATIONS.get(m.type, ())]
    wrong += [f"unknown alignment {m.alignment!r}" for m in mods if m.alignment not in STRATEGIES]
    align, register = bool(raw.get("perform_alignment", True)), bool(raw.get("perform_registration", True))
    wrong += ["registration needs alignment"] if register and not align else []
    ready = [m for m in mods if m.alignment == "pre_aligned"]
    wrong += ["more than one pre-aligned modality"] if len(ready) > 1 else []
    wrong += ["the reference itself can't be pre-aligned"] if any(m.name == reference for m in ready) else []
    spots = reference in by and by[reference].type in SPOT_TYPES
    wrong += ["pre-aligned data need a reference made of spots"] if ready and reference in by and not spots else []
    wrong += [f"an image can't be aligned to the spots of {m.name}" for m in mods if align and reference in by and not spots and m.type in SPOT_TYPES]
    note = raw.get("spatial_annotations")
    if note is not None:
        place = note.get("modality_name") if isinstance(note, dict) else None
        wrong += [f"annotations of an unknown modality {place!r}"] if place not in names else []
        wrong += ["annotations must be geojson"] if not isinstance(note, dict) or note.get("file_type") != "geojson" else []
        wrong += ["annotations of another modality need alignment"] if place in names and place != reference and not align else []
    if inputs and not wrong:
        wrong += _missing_inputs(raw["dataset_path"], mods, raw.get("ignore_samples") or [], note)
    if wrong:
        raise ValueError("; ".join(wrong))
    return Config(raw["dataset_path"], mods, reference, align, register, raw.get("ignore_samples") or [], note)


def _missing_inputs(root: str, mods: list[Modality], ignore: list[str], note: dict | None) -> list[str]:
    if not os.path.isdir(root):
        return [f"no folder {root}"]
    ids = sample_ids(root, set(ignore))
    wrong = [] if ids else [f"no samples in {root}"]
    for m in mods:
        for i in ids:
            folder = os.path.join(root, i, m.name)
            if not os.path.isdir(folder):
                wrong.append(f"no folder {folder}")
                continue
            if m.type == "msi":
                try:
                    ion_modes(folder)
                except FileNotFoundError as e:
                    wrong.append(str(e))
            if note and note["modality_name"] == m.name and (n := sum(f.endswith(".geojson") for f in os.listdir(folder))) != 1:
                wrong.append(f"{n} GeoJSON files in {folder}")
        named = m.settings.get("lipid_annotation_db") if m.type == "msi" else None
        wrong += [f"no mass list {named}"] if named and not os.path.isfile(named) else []
    return wrong


def must_recompute(own: bool, reference_pre: bool, target_pre: bool, registration: bool) -> tuple[bool, bool]:
    """(alignment, registration) force flags: what is made again forces what rests on it."""
    align = own or reference_pre or target_pre
    return align, registration or align


def valid_sample_id(name: str) -> bool:
    return bool(name) and name == name.strip() and not set(name) & set("/\\:") and name not in RESERVED | {".", ".."}
