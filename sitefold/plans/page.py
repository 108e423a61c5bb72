"""The published page: facets, tallies, a map on a canvas and a card for the facility that is pointed at."""

from __future__ import annotations

HEAD = """<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><meta name="viewport" content="width=device-width"><title>@title</title><style>
body{margin:0;font:14px sans-serif;display:flex;height:100vh}#side{width:19em;overflow:auto;padding:1em}#map{flex:1;background:#f4f4f2;touch-action:none}
label{display:block}label b{float:right;font-weight:normal;color:#666}#card{border-top:1px solid #ccc;margin-top:1em;white-space:pre-line}</style></head><body>
<div id="side"><h1>@title</h1><p>@subtitle</p><p id="count"></p><div id="facets"></div><div id="card"></div></div><canvas id="map"></canvas><script>
"""

SCRIPT = """
const hues = ["#b3541e", "#5b7db1", "#c9a227", "#4f8a5b", "#8e5ea2", "#3b8ea5", "#a23b52", "#7a7a7a"];
const unit = r => { const s = Math.sin(r.y / 1e5 * Math.PI / 180); return [(r.x / 1e5 + 180) / 360, 0.5 - Math.log((1 + s) / (1 - s)) / (4 * Math.PI)]; };
const show = data => {
  const dims = data.dictionaries, chosen = {}, map = document.getElementById("map"), pen = map.getContext("2d"), view = {x: 0, y: 0, k: 1};
  const parts = v => v === "" ? ["_none"] : v.split(",");
  const kinds = {species: r => parts(dims.species[r.species_id]), activities: r => parts(dims.activities[r.activities_id]), slaughter: r => [["no", "yes", "not stated"][r.slaughter]], sources: r => parts(dims.sources[r.sources_id])};
  const placed = data.rows.filter(r => r.y !== null && r.x !== null).map(r => ({r, at: unit(r)}));
  const passes = (r, but) => Object.keys(kinds).every(k => k === but || !chosen[k] || !chosen[k].size || kinds[k](r).some(v => chosen[k].has(v)));
  const screen = p => [(p.at[0] - view.x) * view.k * map.width, (p.at[1] - view.y) * view.k * map.width];
  const draw = () => {
    pen.clearRect(0, 0, map.width, map.height);
    for (const p of placed) { if (!passes(p.r)) continue; const [x, y] = screen(p); pen.fillStyle = hues[p.r.palette_id % hues.length]; pen.fillRect(x - 1.5, y - 1.5, 3, 3); }
    document.getElementById("count").textContent = data.rows.filter(r => passes(r)).length + " of " + data.rows.length + " facilities";
  };
  const tally = () => {
    const box = document.getElementById("facets"); box.textContent = "";
    for (const k of Object.keys(kinds)) {
      const n = new Map(); for (const r of data.rows) if (passes(r, k)) for (const v of kinds[k](r)) n.set(v, (n.get(v) || 0) + 1);
      box.append(Object.assign(document.createElement("h3"), {textContent: k}));
      for (const [v, c] of [...n].sort((a, b) => b[1] - a[1])) {
        const line = document.createElement("label"), tick = Object.assign(document.createElement("input"), {type: "checkbox", checked: !!(chosen[k] && chosen[k].has(v))});
        tick.onchange = () => { const s = chosen[k] = chosen[k] || new Set(); tick.checked ? s.add(v) : s.delete(v); tally(); draw(); };
        line.append(tick, v, Object.assign(document.createElement("b"), {textContent: c})); box.append(line);
      }
    }
  };
  const nearest = (x, y) => {
    let best = null, least = 100;
    for (const p of placed) { if (!passes(p.r)) continue; const [a, b] = screen(p), d = (a - x) ** 2 + (b - y) ** 2; if (d < least) { least = d; best = p.r; } }
    return best;
  };
  const size = () => { map.width = map.clientWidth; map.height = map.clientHeight; draw(); };
  map.onwheel = e => { e.preventDefault(); const f = e.deltaY < 0 ? 1.25 : 0.8, w = map.width * view.k; view.x += e.offsetX / w * (1 - 1 / f); view.y += e.offsetY / w * (1 - 1 / f); view.k *= f; draw(); };
  map.onpointermove = e => { if (e.buttons) { const w = map.width * view.k; view.x -= e.movementX / w; view.y -= e.movementY / w; draw(); } };
  map.onclick = e => { const r = nearest(e.offsetX, e.offsetY); document.getElementById("card").textContent = r ? [r.name, dims.country[r.country_id], dims.activities[r.activities_id], r.review ? "to be reviewed" : "", ...r.ids].filter(Boolean).join("\\n") : ""; };
  window.onresize = size; tally(); size();
};
"""

TAIL = "</script></body></html>"
